"""Rows without a partner pass a merge by; none that has one is lost."""

from pyspark.sql import functions as F

from layerforge import RunContext
from layerforge.context import new_run_dir
from layerforge.operators import key_bitmap as B
from layerforge.operators.upsert import upsert
from tests.conftest import plan_text

CTX = RunContext(batch_id="b2")


def _frame(spark, *args):
    # a NULL key, and every key twice as text
    return spark.range(*args).select(F.when(F.col("id") % 97 != 0, F.col("id")).alias("k"),
                                     F.concat(F.lit("k"), F.col("id").cast("string")).alias("name"), F.lit("a").alias("s"))


def test_every_match_is_kept_and_most_others_are_told_apart(spark):
    big, small = _frame(spark, 50_000), _frame(spark, 0, 100_000, 50)
    for keys in (["k"], ["name"], ["k", "name"]):
        near, rest = B.split(big, small, keys, 2_000)
        assert near.count() + rest.count() == 50_000
        assert rest.join(small, keys, "left_semi").isEmpty()
        assert near.count() < 12_000
        assert B.may_match(big, small, keys, 2_000).count() == near.count()


def test_no_source_row_and_keys_that_cannot_be_compared(spark):
    big = _frame(spark, 100)
    near, rest = B.split(big, big.limit(0), ["k"], 0)
    assert (near.count(), rest.count()) == (0, 100)
    other = big.withColumn("k", F.col("k").cast("int"))                 # equal values, other hashes
    assert B.split(big, other, ["k"], 100) == (big, None)
    assert B.split(big, big, ["k"], B.MAX_ROWS * B.BITS + 1) == (big, None)


def test_upsert_with_known_source_rows_is_the_same_merge(spark):
    root = new_run_dir(spark, "bitmap")
    _frame(spark, 20_000).write.parquet(f"{root}/t")
    _frame(spark, 0, 40_000, 40).withColumn("s", F.when(F.col("name") > "k2", F.lit("b")).otherwise(F.lit("a"))).write.parquet(f"{root}/s")
    t, s = spark.read.parquet(f"{root}/t"), spark.read.parquet(f"{root}/s")
    plain, near = (upsert(t, s, "k", "s", ["s"], CTX, source_rows=n) for n in (None, s.count()))
    assert plain.exceptAll(near).isEmpty() and near.exceptAll(plain).isEmpty()
    st = {r["_action"]: r["count"] for r in near.groupBy("_action").count().collect()}
    assert st["keep"] + st["update"] == 20_000 and st["update"] and st["insert"]


def test_source_is_shuffled_once_a_join(spark):
    root = new_run_dir(spark, "once")
    _frame(spark, 1_000).write.parquet(root)
    t = s = spark.read.parquet(root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(upsert(t, s, "k", "s", ["s"], CTX))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 4                 # two joins, two sides each
