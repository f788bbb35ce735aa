import pytest
from pyspark.sql import functions as F

from layerforge.operators import relational as R
from tests.conftest import plan_text


def test_keep_one_edges(spark):
    rows = [("k1", 1, "a"), ("k1", 1, "a"),          # exact duplicate
            ("k2", 5, "b"), ("k2", 5, "a"),          # tie on order column -> tie-breaker
            ("k3", None, "x"), ("k3", 2, "y"),       # NULL order value loses
            ("k4", None, "q"), ("k4", None, "p"),    # all NULL: a row survives
            (None, 1, "n1"), (None, 2, "n2")]        # NULL key is one group
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = {r["k"]: (r["o"], r["v"]) for r in R.keep_one(df, "k", ["o"]).collect()}
    assert got == {"k1": (1, "a"), "k2": (5, "a"), "k3": (2, "y"), "k4": (None, "p"), None: (2, "n2")}


def test_keep_one_is_partitioning_independent(spark):
    df = spark.range(2000).select((F.col("id") % 37).alias("k"), (F.col("id") % 11).alias("o"),
                                  F.col("id").alias("v"))
    a = sorted(R.keep_one(df, "k", ["o"]).collect())
    b = sorted(R.keep_one(df.repartition(7, "v"), "k", ["o"]).collect())
    assert a == b and len(a) == 37


def test_keep_one_plans_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("k"), F.col("id").alias("o"))
    plan = plan_text(R.keep_one(df, "k", ["o"]))
    assert "WindowGroupLimit" in plan


def test_enrich_lookup_modes(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    look = spark.createDataFrame([("a", 10), ("a", 11), ("c", 30)], "k string, v int")
    assert R.enrich(facts, look, ["k"]).count() == 4               # warehouse: multiplies
    first = R.enrich(facts, look, ["k"], lookup_unique="first").collect()
    assert len(first) == 3 and {r["v"] for r in first if r["k"] == "a"} == {10}
    unchecked = R.enrich(facts, look, ["k"], lookup_unique="error")       # declares, runs nothing
    with pytest.raises(Exception):
        unchecked.collect()


def test_orphans_is_anti_join_and_keeps_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    o = R.orphans(child, parent, "k")
    assert sorted([r[0] for r in o.collect()], key=lambda x: (x is None, x)) == [2, None]
    assert "LeftAnti" in plan_text(o)


def test_sample_ids_nulls_bounded_and_empty(spark):
    df = spark.createDataFrame([(None,), (5,), (3,), (9,), (1,), (7,), (8,)], "id int")
    assert R.sample_ids(df, "id").first()[0] == "[null,1,3,5,7]"
    assert R.sample_ids(df.filter("id > 100"), "id").first()[0] == "[]"


def test_aggregates(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert R.excess_duplicates(df, "k").first()[0] == 3
    assert {(r[0], r[1]) for r in R.duplicate_keys(df, "k").collect()} == {(1, 3), (None, 2)}
    assert R.distinct_key_count(df, "k").first()[0] == 2
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    assert str(R.high_water_mark(empty, "ts").first()[0]) == "2000-01-01 00:00:00"
