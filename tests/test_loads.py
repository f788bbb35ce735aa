"""Loads: per-table isolation, snapshot versions, run-log counts."""

from pyspark.sql import functions as F

from layerforge import RunContext
from layerforge.context import new_run_dir
from layerforge.plans import loads as L
from layerforge.sources import sinks as SK
from layerforge.testing import registry as RG
from layerforge.testing import tables as TT

SF = "/root/testdata/sf0.001"


def test_failing_table_is_isolated(spark):
    raw = RG._raw_tables(spark, SF, 1)
    frames = dict(raw.frames)
    # a malformed number: the strict cast of the curate step fails at run time
    frames["products"] = frames["products"].withColumn(
        "product_weight_g", F.when(F.col("product_id") == 1, F.lit("x1"))
                             .otherwise(F.col("product_weight_g").cast("string")))
    root = new_run_dir(spark, "lake")
    log = L.full_load(spark, L.RawTables(frames), f"{root}/curated", RunContext(batch_id="b1"),
                      ops_root=f"{root}/ops")
    st = {r["table_name"]: (r["status"], r["error_message"] is not None) for r in log.collect()}
    assert st["products"] == ("FAILED", True)
    assert all(v == ("SUCCESS", False) for k, v in st.items() if k != "products")
    assert SK.current_version(spark, f"{root}/curated/products") is None     # nothing went live
    states = [r["status"] for r in spark.read.parquet(f"{root}/ops/pipeline_run_log").collect()]
    assert sorted(states) == ["FAILED"] + ["STARTED"] * 6 + ["SUCCESS"] * 5


def test_full_load_counts_and_versions(spark):
    root = new_run_dir(spark, "lake")
    log = L.full_load(spark, RG._raw_tables(spark, SF, 1), f"{root}/curated", RunContext(batch_id="b1"))
    rows = {r["table_name"]: r for r in log.collect()}
    sellers = rows["sellers"]
    assert sellers["records_read"] == TT.raw_sellers(spark, SF).count()
    assert sellers["records_inserted"] == SK.read_current(spark, f"{root}/curated/sellers").count()
    assert sellers["records_skipped"] == sellers["records_read"] - sellers["records_inserted"]
    assert sellers["source_rows"] == sellers["records_read"]
    assert SK.current_version(spark, f"{root}/curated/orders") == "b1"


def test_whole_error_text_and_skipped_children(spark):
    root = new_run_dir(spark, "lake")
    raw = RG._raw_tables(spark, SF, 1)
    L.full_load(spark, raw, f"{root}/curated", RunContext(batch_id="b1"))
    text, raw = "x" * 3000, RG._raw_tables(spark, SF, 2)
    frames = dict(raw.frames, orders=raw["orders"].withColumn(
        "order_status", F.raise_error(F.lit(text)).cast("string")))
    log = L.incremental_load(spark, L.RawTables(frames), f"{root}/curated", RunContext(batch_id="b2"),
                             ops_root=f"{root}/ops")
    rows = {r["table_name"]: r for r in log.collect()}
    assert text in rows["orders"]["error_message"]
    assert {rows[t]["status"] for t in L.FACTS[1:]} == {"SKIPPED"}
    assert rows["sellers"]["status"] == "SUCCESS"
    todo = L.to_rerun(spark, spark.read.parquet(f"{root}/ops/pipeline_run_log"), RunContext(batch_id="b2"))
    assert todo == L.FACTS


def test_high_water_filter_reaches_the_scan_of_the_text_layer(spark):
    from layerforge.sources import csv as CSV
    from layerforge.testing.registry import _RAW_COLS
    src, root = new_run_dir(spark, "landing"), new_run_dir(spark, "raw")
    CSV.write_csv(TT.raw_orders(spark, SF).select(*_RAW_COLS["orders"]), f"{src}/orders.csv")
    CSV.load_raw_csv(spark, f"{src}/orders.csv", CSV.string_schema(_RAW_COLS["orders"]), f"{root}/raw_orders", "v1",
                     typed_copies=["order_purchase_timestamp"])
    raw = L.RawTables({"orders": CSV.read_raw(spark, f"{root}/raw_orders"), "customers": TT.raw_customers(spark, SF)})
    plan = L.orders_delta(raw, "1998-01-01 00:00:00", None)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(_typed_order_purchase_timestamp" in plan
    want = TT.raw_orders(spark, SF).filter("order_purchase_timestamp > '1998-01-01'").select("order_id").distinct().count()
    assert L.orders_delta(raw, "1998-01-01 00:00:00", None).count() == want


def test_a_superseded_version_is_not_written_again(spark):
    import pytest
    root = new_run_dir(spark, "versions")
    for v in ("v1", "v2"):
        SK.write_snapshot(spark.range(2), root, v)
    with pytest.raises(ValueError):
        SK.write_snapshot(spark.range(9), root, "v1")
    assert SK.read_current(spark, root).count() == 2 and SK.current_version(spark, root) == "v2"


def test_partitioned_write_makes_one_file_for_each_small_partition(spark):
    import glob
    root = new_run_dir(spark, "files") + "/t"
    SK.write_full(spark.range(0, 4000, 1, 16).withColumn("m", F.col("id") % 10), root, partition_by=["m"],
                  sort_within=["id"])
    assert len(glob.glob(root.removeprefix("file:") + "/m=*/*.parquet")) == 10


def _layout_lake(spark, **kw):
    root = new_run_dir(spark, "lake")
    L.full_load(spark, RG._raw_tables(spark, SF, 1), f"{root}/curated", RunContext(batch_id="b1"), layout=RG._MONTH_LAYOUT)
    log = L.incremental_load(spark, RG._raw_tables(spark, SF, 2), f"{root}/curated", RG.B2_LOAD, layout=RG._MONTH_LAYOUT, **kw)
    return root, {r["table_name"]: r for r in log.collect()}


def test_resume_of_layout_tables_logs_what_the_batch_did(spark):
    root, first = _layout_lake(spark)
    lost = spark.createDataFrame([], L.RUN_LOG_SCHEMA)                # every table was written, the log is gone
    log = L.resume_incremental(spark, RG._raw_tables(spark, SF, 2), f"{root}/curated", RG.B2_LOAD, lost, layout=RG._MONTH_LAYOUT)
    again = {r["table_name"]: r for r in log.collect()}
    cols = ("records_read", "records_inserted", "records_updated", "status")
    assert first["orders"]["records_inserted"] > 0 and first["orders"]["records_updated"] > 0
    assert [again["orders"][c] for c in cols] == [first["orders"][c] for c in cols]


def test_undo_batch_restores_all_tables_once(spark):
    import pytest
    root, _ = _layout_lake(spark, late_updates=True)
    states = {r["table_name"]: r["state"] for r in L.undo_batch(spark, f"{root}/curated", "b2").collect()}
    assert set(states.values()) == {"undone"} and set(states) == set(L.DIMENSIONS + L.FACTS)
    assert all(SK.read_current(spark, f"{root}/curated/{t}").filter("_batch_id <> 'b1'").isEmpty() for t in L.FACTS)
    again = {r["state"] for r in L.undo_batch(spark, f"{root}/curated", "b2").collect()}
    assert again == {"untouched"}
    SK.write_snapshot(spark.range(5), f"{root}/t", "b1")
    for v in ("b2", "b3"):
        SK.write_snapshot(spark.range(2), f"{root}/t", v)
    with pytest.raises(ValueError):                                   # below a later whole snapshot
        L.undo_batch(spark, root, "b2", tables=["t"])


def test_snapshots_of_two_writers_and_restore(spark, monkeypatch):
    import pytest
    root = new_run_dir(spark, "two-writers")
    SK.write_snapshot(spark.range(1), root, "v1")
    real = SK.write_full

    def slow(*a, **kw):                          # another writer commits while this one writes
        monkeypatch.setattr(SK, "write_full", real)
        SK.write_snapshot(spark.range(2), root, "other")
        real(*a, **kw)
    monkeypatch.setattr(SK, "write_full", slow)
    with pytest.raises(SK.Conflict):
        SK.write_snapshot(spark.range(3), root, "mine")
    assert SK.current_version(spark, root) == "other" and SK.read_current(spark, root).count() == 2
    SK.write_snapshot(spark.range(3), root, "mine")                   # the retry starts from the other's version
    assert SK.restore(spark, root, "mine") == "other" and SK.read_current(spark, root).count() == 2
    SK.write_snapshot(spark.range(7), root, "mine")                   # taken back, so it may be written anew
    assert SK.read_current(spark, root).count() == 7 and SK.current_version(spark, root) == "mine"
    assert SK.restore(spark, root, "mine") == "other" and SK.restore(spark, root, "other") == "v1"
    with pytest.raises(ValueError):
        SK.restore(spark, root, "v1")


def test_the_orders_of_a_large_batch_are_not_broadcast(spark, monkeypatch):
    root = new_run_dir(spark, "large-batch")
    spark.createDataFrame([(1, "b1"), (2, "b2"), (3, "b2"), (None, "b2")], "order_id long, _batch_id string").write.parquet(f"{root}/orders")
    items = [(o, n, 3, 7, None, 1.0, 0.5) for o in (1, 2, 3, 3, None) for n in (1, 2)]
    raw = L.RawTables({"order_items": spark.createDataFrame(
        items, "order_id long, order_item_id int, product_id long, seller_id long, shipping_limit_date timestamp_ntz, price double, freight_value double")})
    orders = spark.read.parquet(f"{root}/orders")
    semi = lambda df: [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "LeftSemi" in x]
    found = []
    for limit, join in ((100, "BroadcastHashJoin"), (2, "SortMergeJoin")):
        monkeypatch.setattr(L, "BROADCAST_KEYS", limit)
        df = L.child_delta("order_items", raw, orders, RunContext(batch_id="b2"))
        assert len(semi(df)) == 1 and join in semi(df)[0]
        found.append(sorted((r["order_id"], r["order_item_id"]) for r in df.collect()))
    assert found == [[(2, 1), (2, 2), (3, 1), (3, 2)]] * 2
