from datetime import datetime

from pyspark.sql import functions as F

from layerforge import RunContext
from layerforge.plans import contracts as X


def test_schema_diff(spark):
    old = spark.createDataFrame([], "a int, b string, c double")
    new = spark.createDataFrame([], "a bigint, b string, d string")
    diff = X.schema_diff(X.schema_snapshot(spark, old), X.schema_snapshot(spark, new))
    got = {r["column_name"]: (r["change"], r["severity"]) for r in diff.collect()}
    assert got == {"a": ("type_changed", "BREAKING"), "c": ("dropped", "BREAKING"),
                   "d": ("added", "WARNING")}


def test_expired_and_freshness(spark):
    log = spark.createDataFrame([("old", datetime(2024, 1, 1)), ("new", datetime(2024, 5, 1))],
                                "batch_id string, run_timestamp timestamp_ntz")
    assert [r[0] for r in X.expired(log, "2024-05-02 00:00:00", 90).collect()] == ["old"]
    f = X.freshness(log, "run_timestamp", "2024-05-02 00:00:00", 24).first()
    assert f["stale"] is False and abs(f["age_hours"] - 24.0) < 1e-9
    empty = X.freshness(log.limit(0), "run_timestamp", "2024-05-02 00:00:00", 24).first()
    assert empty["stale"] is True


def test_contract_and_rejects(spark):
    df = spark.createDataFrame([("1", "a", 5), ("x", None, 9), ("3", "b", 1)], "n string, s string, v int")
    r = X.validate_contract(df, {"columns": {"n": {"type": "bigint"}, "s": {"nullable": False,
                                                                           "allowed": ["a"]},
                                             "v": {"range": (1, 5)}}}).first()
    assert (r["rows"], r["n__type"], r["s__null"], r["s__allowed"], r["v__range"]) == (3, 1, 1, 1, 1)
    good, rej = X.split_rejects(df, {"bad_n": X.try_cast_failed("n", "bigint"),
                                     "no_s": F.col("s").isNull()}, RunContext(batch_id="b"))
    assert good.count() == 2
    assert rej.select("reject_reason").first()[0] == "bad_n,no_s"


def test_threshold_and_pending(spark):
    res = spark.createDataFrame([("c1", 1, 10), ("c2", 1, 10000), ("c3", 0, 0)],
                                "check_name string, affected_count long, total_count long")
    got = {r["check_name"]: r["alert"] for r in X.with_threshold(res, {"c2": 0.001}, 0.0).collect()}
    assert got == {"c1": True, "c2": False, "c3": False}
    log = spark.createDataFrame([("b", "t1", "SUCCESS"), ("b", "t2", "FAILED")],
                                "batch_id string, table_name string, status string")
    assert sorted(r[0] for r in X.pending_tables(spark, log, "b", ["t1", "t2", "t3"]).collect()) == ["t2", "t3"]


def test_drop_batch_for_replay(spark):
    df = spark.createDataFrame([(1, "b1"), (2, "b2"), (3, None)], "k int, _batch_id string")
    assert sorted(r[0] for r in X.drop_batch(df, "b2").collect()) == [1, 3]


def test_missing_column_and_null_rate(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "b")], "k int, s string")
    contract = {"columns": {"s": {"max_null_rate": 0.25}, "gone": {"type": "int", "nullable": False}}}
    r = X.validate_contract(df, contract).first()
    assert (r["s__missing"], r["s__null_rate"], r["gone__missing"]) == (0, 1, 1)
    rows = {r["check_name"]: (r["status"], r["affected_count"], r["total_count"])
            for r in X.contract_checks(df, "t", contract, RunContext(batch_id="b")).collect()}
    assert rows == {"contract_t_s__missing": ("PASS", 0, 4), "contract_t_s__null_rate": ("FAIL", 1, 4),
                    "contract_t_gone__missing": ("FAIL", 1, 4)}


def test_empty_days_are_listed(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5),), (datetime(2024, 1, 4),), (None,)], "ts timestamp_ntz")
    got = {str(r["day"]): r["rows"] for r in X.daily_volume_breaches(df, "ts", 1).collect()}
    assert got == {"2024-01-02": 0, "2024-01-03": 0}
    more = X.daily_volume_breaches(df, "ts", 1, "2023-12-31", "2024-01-02").collect()
    assert sorted(str(r["day"]) for r in more) == ["2023-12-31", "2024-01-02"]
    assert X.daily_volume_breaches(df.limit(0), "ts", 1).collect() == []


def test_schema_versions_halt_on_a_breaking_change(spark):
    import pytest
    from layerforge.context import new_run_dir
    path = new_run_dir(spark, "schema-versions")
    v1 = spark.createDataFrame([], "a int, b string")
    run = lambda n: RunContext(batch_id=f"b{n}", run_ts=datetime(2024, 1, n))
    assert X.record_schema(spark, v1, "t", run(1), path).count() == 0
    wider = spark.createDataFrame([], "a int, b string, c string")
    assert [r["change"] for r in X.record_schema(spark, wider, "t", run(2), path).collect()] == ["added"]
    with pytest.raises(X.BreakingSchemaChange):
        X.record_schema(spark, v1, "t", run(3), path)
    assert X.record_schema(spark, v1, "u", run(3), path).count() == 0        # another table
    stored = spark.read.parquet(path)
    assert {(r["table_name"], r["batch_id"]) for r in stored.collect()} == {("t", "b1"), ("t", "b2"), ("u", "b3")}


def test_a_live_version_never_expires(spark):
    from datetime import datetime

    from layerforge.context import new_run_dir
    from layerforge.sources import sinks as SK
    from layerforge.sources import versions as V
    root = new_run_dir(spark, "lake")
    SK.write_snapshot(spark.range(1), f"{root}/a", "old")
    V.replace(spark.range(1), f"{root}/b", "older")
    log = spark.createDataFrame([(b, datetime(2020, 1, 1)) for b in ("old", "older", "gone")], "batch_id string, run_timestamp timestamp_ntz")
    live = X.live_versions(spark, root, ["a", "b", "never_written"])
    assert live == ["old", "older"]
    assert [r[0] for r in X.expired(log, "2024-05-02 00:00:00", 90, live).collect()] == ["gone"]
