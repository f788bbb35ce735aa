"""Counts by key from differences against the full checks."""

import random

from pyspark.sql import functions as F

from layerforge import RunContext
from layerforge.context import new_run_dir
from layerforge.operators import key_counts as K
from layerforge.operators import quality as Q
from layerforge.operators.upsert import upsert_files
from layerforge.sources import versions as V

SCHEMA = "id long, k long, s string"


def result(df):
    return tuple(df.first())


def test_equal_to_the_full_checks_after_each_batch(spark):
    rng = random.Random(5)
    child, parent = new_run_dir(spark, "child"), new_run_dir(spark, "parent")
    counts = {n: new_run_dir(spark, f"counts-{n}") for n in ("child", "parent")}
    rows = lambda lo, hi: [(i, rng.choice([None, 7, 7, 7, *range(60)]), "a") for i in range(lo, hi)]
    V.replace(spark.createDataFrame(rows(0, 300), SCHEMA), child, "b1")
    V.replace(spark.createDataFrame([(k, k, "p") for k in range(0, 40, 2)], SCHEMA), parent, "b1")

    def agree():
        K.refresh(spark, child, counts["child"], ["k"], buckets=8)
        K.refresh(spark, parent, counts["parent"], ["k"], buckets=8)
        assert result(K.check_unique(spark, counts["child"], ["k"])) == result(Q.check_unique(V.read(spark, child), "k"))
        assert (result(K.check_foreign_key(spark, counts["child"], counts["parent"], "k"))
                == result(Q.check_foreign_key(V.read(spark, child), V.read(spark, parent), "k")))

    agree()
    V.append(spark.createDataFrame(rows(300, 400), SCHEMA), child, "b2")
    V.append(spark.createDataFrame([(1, 1, "p"), (3, 3, "p")], SCHEMA), parent, "b2")
    agree()
    moved = spark.createDataFrame([(i, 100 + i % 3, "moved") for i in range(0, 50)], SCHEMA)          # keys change
    upsert_files(spark, child, moved, "id", "s", ["k", "s"], RunContext(batch_id="b3"))
    agree()
    V.undo(spark, child, "b3", ["id"])
    V.undo(spark, parent, "b2", ["k"])
    agree()
    before = V.head(spark, counts["child"])
    assert K.refresh(spark, child, counts["child"], ["k"]) == before                                  # nothing to do


def test_only_the_difference_and_touched_buckets_are_read(spark):
    root, counts = new_run_dir(spark, "wide"), new_run_dir(spark, "wide-counts")
    V.replace(spark.range(5000).select(F.col("id"), (F.col("id") % 2000).alias("k")).repartitionByRange(16, "id"), root, "b1")
    K.refresh(spark, root, counts, ["k"], buckets=32)
    V.append(spark.createDataFrame([(9000, 5), (9001, 5)], "id long, k long"), root, "b2")
    old = V.head(spark, counts)
    new = K.refresh(spark, root, counts, ["k"], buckets=32)
    carried = V.files(spark, counts, new).join(V.files(spark, counts, old).select("path"), "path", "left_semi")
    assert V.files(spark, counts, new).select("part").distinct().count() == 32
    assert carried.select("part").distinct().count() == 31
    diff = V.changes(spark, root, V.at_number(spark, root, 0), V.head(spark, root), ["k"])
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(16 paths)" not in plan and diff.count() == 2
    assert K.read(spark, counts).filter("k = 5").first()["cnt"] == 5


def test_key_changes_are_the_changes_by_key_from_the_keys_alone(spark):
    root = new_run_dir(spark, "key-changes")
    old = V.replace(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (4, "d")], "k long, s string"), root, "b1")
    new = V.replace(spark.createDataFrame([(1, "a"), (2, "z"), (None, "c"), (None, "e"), (5, "d")], "k long, s string"), root, "b2")
    net = V.key_changes(spark, root, old, new, ["k"])
    assert {(r["k"], r["cnt"]) for r in net.collect()} == {(1, -1), (None, 1), (4, -1), (5, 1)}
    sign = F.when(F.col("_change").isin("insert", "after"), 1).otherwise(-1)
    long_way = V.changes(spark, root, old, new, ["k"]).groupBy("k").agg(F.sum(sign).alias("cnt")).filter("cnt <> 0")
    assert net.exceptAll(long_way).isEmpty() and long_way.exceptAll(net).isEmpty()
    scans = [x for x in net._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert scans and not any("s#" in x.split("Batched")[0] for x in scans)


def test_the_keys_of_the_parent_are_not_broadcast(spark):
    child, parent = new_run_dir(spark, "child-counts"), new_run_dir(spark, "parent-counts")
    V.replace(spark.createDataFrame([(1, 3, 0), (2, 1, 0), (None, 4, 0), (9, 2, 0)], "k long, cnt long, _bucket int"), child, "0", [K.BUCKET])
    V.replace(spark.createDataFrame([(1, 1, 0), (2, 2, 0), (None, 1, 0)], "k long, cnt long, _bucket int"), parent, "0", [K.BUCKET])
    checked = K.check_foreign_key(spark, child, parent, "k")
    plan = checked._jdf.queryExecution().executedPlan().toString()
    # their files are far below the broadcast threshold, as those of many keys can be
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    # a NULL key is no order's: 4 rows of it and the 2 of key 9
    assert result(checked.select("affected_count", "total_count")) == (6, 10)
