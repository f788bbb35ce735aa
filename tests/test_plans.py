"""Plan checks on a raw layer stored as parquet (as the ingest writes it)."""

import tempfile

from pyspark.sql import functions as F

from layerforge.operators import quality as Q
from layerforge.operators import relational as R
from layerforge.plans import curate as C
from layerforge.plans import loads as L
from layerforge.sources.sinks import write_full
from layerforge.testing import tables as TT
from tests.conftest import plan_text

SF = "/root/testdata/sf0.001"


def _raw_parquet(spark):
    path = tempfile.mkdtemp(prefix="lf-rawpq-", dir="/tmp") + "/raw_orders"
    write_full(TT.raw_orders(spark, SF), path)
    return spark.read.parquet(path)


def test_high_water_filter_reaches_the_scan(spark):
    raw = _raw_parquet(spark)
    delta = L.orders_delta(L.RawTables({"orders": raw, "customers": TT.raw_customers(spark, SF)}),
                           "1998-01-01 00:00:00", None)
    plan = plan_text(delta)
    assert "GreaterThan(order_purchase_timestamp" in plan       # pushed into the parquet scan
    assert "WindowGroupLimit" in plan


def test_curated_scan_reads_only_needed_columns(spark):
    raw = _raw_parquet(spark)
    q = C.clean_orders(raw).select("order_id")
    plan = plan_text(q)
    assert "IsNotNull(order_id)" in plan


def test_checks_are_aggregates_with_bounded_samples(spark):
    raw = _raw_parquet(spark)
    f = Q.check_not_null(raw, ["order_status"], "order_id")
    plan = plan_text(f)
    assert "TakeOrderedAndProject" in plan and "HashAggregate" in plan
    u = plan_text(Q.check_unique(raw, "order_id"))
    assert "partial_count" in u


def test_keys_missing_in_uses_anti_join(spark):
    raw = _raw_parquet(spark)
    other = raw.filter(F.col("order_id") % 2 == 0)
    assert "LeftAnti" in plan_text(R.keys_missing_in(raw, other, "order_id"))
