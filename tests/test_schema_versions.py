"""Versions of different schemas read as one, and the guard in the loads."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge import RunContext
from layerforge.context import new_run_dir
from layerforge.operators.upsert import upsert_files
from layerforge.sources import versions as V


def schema(text):
    return T.StructType.fromDDL(text)


def test_merged_schema(spark):
    a, b = schema("k int, d date, x float, n decimal(5,2)"), schema("k long, s string, d timestamp_ntz, x float, n decimal(6,1)")
    assert V.merged_schema(a, b).simpleString() == "struct<k:bigint,d:timestamp_ntz,x:float,n:decimal(7,2),s:string>"
    assert V.merged_schema(b, a)["k"].dataType.simpleString() == "bigint"
    for x, y in (("k int", "k string"), ("k long", "k int, j int"), ("n decimal(38,0)", "n decimal(5,3)")):
        if x != "k long":
            with pytest.raises(V.IncompatibleSchema):
                V.merged_schema(schema(x), schema(y))
    assert V.merged_schema(schema("k long"), schema("k int, j int")).simpleString() == "struct<k:bigint,j:int>"


def test_carried_files_are_read_under_the_new_schema(spark):
    root = new_run_dir(spark, "evolving")
    V.replace(spark.createDataFrame([(1, 10, "a"), (2, 20, "a")], "k int, v int, s string").repartitionByRange(2, "k"), root, "b1")
    first = V.files(spark, root, V.head(spark, root))
    src = spark.createDataFrame([(2, 2 ** 40, "b", "new"), (3, 7, "c", None)], "k long, v long, s string, note string")
    upsert_files(spark, root, src, "k", "s", ["s", "v", "note"], RunContext(batch_id="b2"), evolve=True)
    got = sorted(map(tuple, V.read(spark, root).select("k", "v", "s", "note").collect()))
    assert got == [(1, 10, "a", None), (2, 2 ** 40, "b", "new"), (3, 7, "c", None)]
    assert V.files(spark, root, V.head(spark, root)).join(first, "path", "left_semi").count() == 1        # carried over as it was
    assert V.read(spark, root, "b1").columns == ["k", "v", "s"]
    old, new = V.history(spark, root)
    kinds = sorted((r["k"], r["_change"]) for r in V.changes(spark, root, old, new, ["k"]).collect())
    assert kinds == [(2, "after"), (2, "before"), (3, "insert")]
    both = V.read_versions(spark, root, ["b1", "b2"])
    assert both.columns == ["k", "v", "s", "note", "_version"] and both.count() == 5
    V.undo(spark, root, "b2", ["k"])
    assert sorted(map(tuple, V.read(spark, root).collect())) == [(1, 10, "a"), (2, 20, "a")]


def test_a_merge_without_a_column_of_the_table_fails(spark):
    root = new_run_dir(spark, "narrow")
    V.replace(spark.createDataFrame([(1, "a", 5)], "k int, s string, v int"), root, "b1")
    with pytest.raises(Exception):
        upsert_files(spark, root, spark.createDataFrame([(2, "b")], "k int, s string"), "k", "s", ["s"], RunContext(batch_id="b2"))
    assert V.head(spark, root).version == "b1"
    with pytest.raises(V.IncompatibleSchema):
        V.append(spark.createDataFrame([("x", "b")], "k string, s string"), root, "b2", evolve=True)
    V.append(spark.createDataFrame([(2, "b")], "k int, s string"), root, "b2", evolve=True)
    assert V.read(spark, root).filter("k = 2").select(F.col("v")).first()[0] is None
