"""A third of all rows on one key: results stay whole and exact, and the
plans pre-aggregate before shuffling."""

from pyspark.sql import functions as F

from layerforge import RunContext
from layerforge.context import new_run_dir
from layerforge.operators import quality as Q
from layerforge.operators import relational as R
from layerforge.operators.upsert import upsert
from tests.conftest import plan_text

N = 30000


def hot(spark):
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("o"))


def test_keep_one_hot_key(spark):
    out = R.keep_one(hot(spark), "k", ["o"])
    rows = {r["k"]: r["o"] for r in out.collect()}
    assert len(rows) == N - N // 3 + 1
    assert rows[-1] == N - 3                       # latest of the hot group wins


def test_checks_hot_key(spark):
    df = hot(spark)
    u = Q.check_unique(df, "k").first()
    assert u["affected_count"] == N // 3 - 1 and u["total_count"] == N
    parent = spark.range(1, N).select(F.col("id").alias("k"))      # no parent for the hot key
    fk = Q.check_foreign_key(df, parent, "k")
    r = fk.first()
    assert r["affected_count"] == N // 3          # every hot-key row is an orphan
    assert r["sample_ids"] == "[-1,-1,-1,-1,-1]"
    plan = plan_text(fk)
    assert "LeftAnti" in plan and "partial_count" in plan


def test_upsert_null_key_hot_spot(spark):
    ctx = RunContext(batch_id="b2")
    t = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id"))
                              .cast("bigint").alias("k"), F.lit("a").alias("s"))
    src = spark.range(N, N + 10).select(F.col("id").alias("k"), F.lit("b").alias("s"))
    out = upsert(t, src, "k", "s", ["s"], ctx)
    assert out.count() == N + 10
    assert out.filter("k is null and _action = 'keep'").count() == N // 3


def test_upsert_hot_target_key(spark):
    ctx = RunContext(batch_id="b2")
    t = hot(spark).select("k", F.lit("a").alias("s"))
    src = spark.createDataFrame([(-1, "b"), (1, "b"), (N + 1, "b")], "k long, s string")
    out = upsert(t, src, "k", "s", ["s"], ctx)
    st = {r["_action"]: r["count"] for r in out.groupBy("_action").count().collect()}
    assert st == {"update": N // 3 + 1, "keep": N - N // 3 - 1, "insert": 1}


def test_upsert_plan_has_two_target_scans_and_no_full_outer_join(spark):
    ctx = RunContext(batch_id="b2")
    path = new_run_dir(spark, "target")
    spark.range(N).select(F.col("id").alias("k"), F.lit("a").alias("s")).write.parquet(path)
    t = spark.read.parquet(path)
    src = spark.range(5).select(F.col("id").alias("k"), F.lit("b").alias("s"))
    out = upsert(t, src, "k", "s", ["s"], ctx)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2 and "FullOuter" not in plan
    st = {r["_action"]: r["count"] for r in out.groupBy("_action").count().collect()}
    assert st == {"update": 5, "keep": N - 5}
