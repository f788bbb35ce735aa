import pytest
from pyspark.sql import functions as F

from layerforge import RunContext
from layerforge.operators import quality as Q

CTX = RunContext(batch_id="dq")


def test_row_check_empty_and_nulls(spark):
    empty = spark.createDataFrame([], "id int, s string")
    r = Q.check_not_null(empty, ["s"], "id").first()
    assert (r["affected_count"], r["total_count"], r["sample_ids"]) == (0, 0, "[]")
    df = spark.createDataFrame([(None, None), (1, "x"), (2, None)], "id int, s string")
    r = Q.check_not_null(df, ["s"], "id").first()
    assert (r["affected_count"], r["total_count"], r["sample_ids"]) == (2, 3, "[null,2]")


def test_domain_null_not_counted(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "zz")], "id int, s string")
    r = Q.check_domain(df, "s", ["a"], "id").first()
    assert r["affected_count"] == 1 and r["sample_ids"] == "[3]"


def test_unique_null_group_and_sample_bound(spark):
    df = spark.range(40).select((F.col("id") % 8).alias("k"))
    r = Q.check_unique(df, "k").first()
    assert r["affected_count"] == 32 and r["sample_ids"] == "[0,1,2,3,4]"
    n = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert Q.check_unique(n, "k").first()["affected_count"] == 1


def test_runner_error_pct_summary_gate(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, s string")
    bad = spark.createDataFrame([("x",)], "v string").select(F.col("v").cast("int").alias("affected_count"),
                                                              F.lit(1).alias("total_count"),
                                                              F.lit("[]").alias("sample_ids"))
    checks = [
        Q.Check("nn", "d", "t", "CRITICAL", df=df, predicate=F.col("s").isNull(), id_col="id"),
        Q.Check("dom", "d", "t", "WARNING", df=df, predicate=F.col("s") == "x", id_col="id"),
        Q.Check("boom", "d", "t", "CRITICAL", frame=bad),
        Q.Check("empty", "d", "t", "INFO", frame=Q.check_not_null(df.limit(0), ["s"], "id")),
    ]
    res = Q.run_checks(spark, checks, CTX)
    got = {r["check_name"]: (r["status"], r["affected_count"], r["total_count"]) for r in res.collect()}
    assert got == {"nn": ("FAIL", 1, 2), "dom": ("FAIL", 1, 2), "boom": ("ERROR", -1, 0),
                   "empty": ("PASS", 0, 0)}
    pct = {r["check_name"]: r["violation_pct"] for r in Q.with_pct(res).collect()}
    assert pct["nn"] == "50.00%" and pct["empty"] == "n/a" and pct["boom"] == "n/a"
    s = Q.summarize_checks(res).first()
    assert (s["passed"], s["failed"], s["errored"], s["total"]) == (1, 2, 1, 4)
    with pytest.raises(Q.QualityGateError):
        Q.gate(res)
    only_error = res.filter("check_name in ('boom', 'dom')")
    Q.gate(only_error)                       # an erroring CRITICAL check does not trip by default
    with pytest.raises(Q.QualityGateError):
        Q.gate(only_error, strict=True)


def test_fused_matches_unfused(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("m"))
    mk = lambda: [Q.Check("a", "", "t", "WARNING", df=df, predicate=F.col("m") == 0, id_col="id"),
                  Q.Check("b", "", "t", "WARNING", df=df, predicate=F.col("m") == 1, id_col="id")]
    a = Q.evaluate_checks(mk(), CTX, fuse=True)
    b = Q.evaluate_checks(mk(), CTX, fuse=False)
    assert a == b
