"""Order of the ops reports."""

from datetime import datetime

from layerforge.operators.quality import DQ_SCHEMA
from layerforge.plans import ops as R
from layerforge.sources.sinks import RUN_LOG_SCHEMA


def at(day):
    return datetime(2024, 1, day)


def test_runs_newest_first(spark):
    rows = [("b", "FULL", f"t{d}", 1, 1, 0, 0, "SUCCESS", None, at(d), 1.0, 1) for d in (3, 9, 1, 7)]
    got = R.report_runs(spark.createDataFrame(rows, RUN_LOG_SCHEMA).repartition(3)).collect()
    assert [r["table_name"] for r in got] == ["t9", "t7", "t3", "t1"]


def test_results_and_failures_in_order(spark):
    rows = [("b", f"c{d}{sev[0]}", "", "t", sev, status, 1, 2, "[]", at(d))
            for d in (2, 5, 4) for sev, status in (("WARNING", "FAIL"), ("CRITICAL", "FAIL"), ("ERROR", "PASS"))]
    df = spark.createDataFrame(rows, DQ_SCHEMA).repartition(3)
    assert [r["check_timestamp"].day for r in R.report_dq(df).collect()] == [5, 5, 5, 4, 4, 4, 2, 2, 2]
    assert [r["check_name"] for r in R.report_failures(df).collect()] == ["c5C", "c4C", "c2C", "c5W", "c4W", "c2W"]
