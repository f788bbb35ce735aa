import os
import tempfile

import pytest
from pyspark.sql import functions as F

from layerforge.sources import csv as CSV
from layerforge.sources import sinks as SK


def write(text: bytes) -> str:
    d = tempfile.mkdtemp(prefix="lf-csv-", dir="/tmp")
    p = os.path.join(d, "f.csv")
    with open(p, "wb") as fh:
        fh.write(text)
    return p


SCHEMA = CSV.string_schema(["a", "b", "c"])


def test_csv_edge_rows(spark):
    p = write(b'\xef\xbb\xbfa,b,c\n1,"x\ny",01037\n2,,""\n3,"he said ""hi""",5\n4,5,6,7\n')
    good, rej = CSV.read_raw_csv(spark, p, SCHEMA, max_bad=1, multiline=True)
    rows = {r["a"]: (r["b"], r["c"]) for r in good.collect()}
    assert rows == {"1": ("x\ny", "01037"), "2": (None, None), "3": ('he said "hi"', "5")}
    assert good.columns == ["a", "b", "c"]                # BOM not part of the first name
    assert good.count() == 3 and good.select("b").count() == 3   # pruned scans still allowed
    assert rej.count() == 1
    with pytest.raises(CSV.BadRecordBudgetExceeded):
        CSV.read_raw_csv(spark, p, SCHEMA, max_bad=0, multiline=True)


def test_load_raw_csv_budget_keeps_live_version(spark):
    ok = write(b"a,b,c\n1,2,3\n")
    bad = write(b"a,b,c\n1,2,3\n4,5,6,7\n8\n")
    root = tempfile.mkdtemp(prefix="lf-raw-", dir="/tmp") + "/t"
    assert CSV.load_raw_csv(spark, ok, SCHEMA, root, "v1") == {"rows": 1, "rejected": 0}
    with pytest.raises(CSV.BadRecordBudgetExceeded):
        CSV.load_raw_csv(spark, bad, SCHEMA, root, "v2", max_bad=1)
    assert CSV.read_raw(spark, root).count() == 1         # v1 still live
    m = CSV.load_raw_csv(spark, bad, SCHEMA, root, "v3", max_bad=2)
    assert m == {"rows": 1, "rejected": 2}


def test_ingest_all_reports_missing(spark):
    d = os.path.dirname(write(b"a,b,c\n1,2,3\n"))
    rep = CSV.ingest_all(spark, d, {"f.csv": ("t1", ["a", "b", "c"]), "nope.csv": ("t2", ["a"])},
                         tempfile.mkdtemp(prefix="lf-raw-", dir="/tmp"), "v1")
    got = {r["table_name"]: (r["status"], r["rows_loaded"]) for r in rep.collect()}
    assert got == {"t1": ("LOADED", 1), "t2": ("MISSING", 0)}


def test_snapshot_pointer_and_ops_tables(spark):
    root = tempfile.mkdtemp(prefix="lf-snap-", dir="/tmp")
    SK.write_snapshot(spark.range(3), f"{root}/t", "v1")
    SK.write_snapshot(SK.read_current(spark, f"{root}/t").filter("id > 0"), f"{root}/t", "v2")
    assert SK.read_current(spark, f"{root}/t").count() == 2
    with pytest.raises(ValueError):
        SK.write_snapshot(spark.range(1), f"{root}/t", "v2")
    assert SK.ensure_ops_tables(spark, f"{root}/ops") == {"pipeline_run_log": True, "dq_results": True}
    assert SK.ensure_ops_tables(spark, f"{root}/ops") == {"pipeline_run_log": False, "dq_results": False}


def test_file_name_lineage(spark):
    p = write(b"a,b,c\n1,2,3\n")
    root = tempfile.mkdtemp(prefix="lf-raw-", dir="/tmp") + "/t"
    CSV.load_raw_csv(spark, p, SCHEMA, root, "v1", with_file_name=True)
    assert CSV.read_raw(spark, root).select("_source_file").first()[0] == "f.csv"


def test_conversion_failures_count_as_bad_records(spark):
    p = write(b"a,b,c\n1,2,3\nx,2,3\n4,,3\n")
    root = tempfile.mkdtemp(prefix="lf-raw-", dir="/tmp") + "/t"
    with pytest.raises(CSV.BadRecordBudgetExceeded):
        CSV.load_raw_csv(spark, p, SCHEMA, root, "v1", types={"a": "bigint", "b": "int"})
    m = CSV.load_raw_csv(spark, p, SCHEMA, root, "v2", max_bad=1, types={"a": "bigint", "b": "int"})
    assert m == {"rows": 2, "rejected": 1}                   # empty b is NULL, not a failure
    assert sorted(r["a"] for r in CSV.read_raw(spark, root).collect()) == ["1", "4"]


def test_good_rows_are_written_by_the_tasks_that_parse_them(spark):
    src, root = tempfile.mkdtemp(prefix="lf-csv-", dir="/tmp") + "/f.csv", tempfile.mkdtemp(prefix="lf-raw-", dir="/tmp") + "/t"
    spark.range(4000).select(*[F.col("id").alias(c) for c in "abc"]).repartition(4).write.option("header", True).csv(src)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert CSV.load_raw_csv(spark, src, SCHEMA, root, "v1") == {"rows": 4000, "rejected": 0}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    back = CSV.read_raw(spark, root)
    assert back.count() == 4000 and len(back.inputFiles()) > 1           # no shuffle gathered them


def test_rejects_of_an_attempt_over_budget_do_not_stay(spark):
    root = tempfile.mkdtemp(prefix="lf-raw-", dir="/tmp") + "/t"
    with pytest.raises(CSV.BadRecordBudgetExceeded):
        CSV.load_raw_csv(spark, write(b"a,b,c\n1,2,3\n1,2,3,4\n"), SCHEMA, root, "v1")
    assert CSV.load_raw_csv(spark, write(b"a,b,c\n5,2,3\n"), SCHEMA, root, "v1") == {"rows": 1, "rejected": 0}
    assert [r["a"] for r in spark.read.parquet(f"{root}/v=v1").collect()] == ["5"]


def test_compressed_text_round_trip(spark):
    src, root = tempfile.mkdtemp(prefix="lf-csv-", dir="/tmp") + "/f.csv", tempfile.mkdtemp(prefix="lf-raw-", dir="/tmp") + "/t"
    rows = [("1", " x ", "a\nb"), ("2", None, 'q"q'), ("3", "y,z", "c")]
    CSV.write_csv(spark.createDataFrame(rows, "a string, b string, c string"), src, compression="gzip", rows_a_file=1)
    assert CSV.load_raw_csv(spark, src, SCHEMA, root, "v1", multiline=True) == {"rows": 3, "rejected": 0}
    assert sorted(tuple(r) for r in CSV.read_raw(spark, root).collect()) == rows
