import pytest
from pyspark.sql import functions as F

from layerforge import RunContext
from layerforge.operators.upsert import merge_stats, newer_than, upsert

CTX = RunContext(batch_id="b2")
SCHEMA = "k int, status string, note string, _source_file string, _load_timestamp timestamp, _batch_id string"


def target(spark):
    rows = [(1, "a", "n1"), (2, "a", "n2"), (3, None, "n3"), (4, "a", "n4"), (None, "z", "nz")]
    return spark.createDataFrame([r + ("src", None, "b1") for r in rows], SCHEMA)


def source(spark, rows=None):
    rows = rows if rows is not None else [(1, "b", "new"), (2, "a", "new"), (3, "b", "new"),
                                          (5, "c", "new"), (None, "q", "new")]
    return spark.createDataFrame(rows, "k int, status string, note string")


def test_upsert_semantics(spark):
    out = upsert(target(spark), source(spark), "k", "status", ["status"], CTX,
                 source_label="lbl")
    got = {(r["k"], r["status"], r["note"], r["_batch_id"], r["_action"]) for r in out.collect()}
    assert got == {
        (1, "b", "n1", "b2", "update"),       # changed: listed column only
        (2, "a", "n2", "b1", "keep"),         # unchanged
        (3, None, "n3", "b1", "keep"),        # NULL target value: not "changed"
        (4, "a", "n4", "b1", "keep"),         # untouched
        (None, "z", "nz", "b1", "keep"),      # NULL target key kept
        (5, "c", "new", "b2", "insert"),      # new key
        (None, "q", "new", "b2", "insert"),   # NULL source key never matches
    }
    assert {r["_source_file"] for r in out.filter("_action = 'insert'").collect()} == {"lbl"}
    st = merge_stats(out).first()
    assert (st["inserted"], st["updated"], st["kept"], st["total"]) == (2, 1, 4, 7)


def test_upsert_idempotent(spark):
    once = upsert(target(spark), source(spark), "k", "status", ["status"], CTX).drop("_action")
    twice = upsert(once, source(spark).filter("k is not null"), "k", "status", ["status"], CTX)
    assert twice.filter("_action != 'keep'").count() == 0
    assert twice.count() == once.count()


def test_upsert_duplicate_source_key_fails(spark):
    src = source(spark, [(1, "x", "a"), (1, "y", "b")])
    with pytest.raises(Exception):
        upsert(target(spark), src, "k", "status", ["status"], CTX).collect()


def test_upsert_empty_sides(spark):
    empty_t = target(spark).limit(0)
    out = upsert(empty_t, source(spark), "k", "status", ["status"], CTX)
    assert out.count() == 5 and out.filter("_action = 'insert'").count() == 5
    out2 = upsert(target(spark), source(spark, []), "k", "status", ["status"], CTX)
    assert out2.count() == 5 and out2.filter("_action = 'keep'").count() == 5


def test_newer_than_strict(spark):
    from datetime import datetime
    df = spark.createDataFrame([(datetime(2020, 1, 1),), (datetime(2020, 1, 2),), (None,)],
                               "ts timestamp_ntz")
    assert newer_than(df, "ts", "2020-01-01 00:00:00").count() == 1


def test_upsert_partitions_rewrites_only_touched(spark):
    from layerforge.context import new_run_dir
    from layerforge.operators.upsert import upsert_partitions
    from layerforge.sources import versions as V
    root = new_run_dir(spark, "parts")
    t = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("s"), (F.col("id") % 10).alias("m"))
    V.replace(t, root, "b1", ["m"])
    before = {r["path"] for r in V.files(spark, root, V.head(spark, root)).collect()}
    src = spark.createDataFrame([(3, "b"), (200, "c"), (13, "a")], "k long, s string")
    res = upsert_partitions(spark, root, src, "k", "s", ["s"], CTX, "m", lambda d: F.col("k") % 10)
    assert {k: res[k] for k in ("partitions", "inserted", "updated", "kept")} == {
        "partitions": [0, 3], "inserted": 1, "updated": 1, "kept": 19}
    back = V.read(spark, root)
    assert back.count() == 101
    assert back.filter("k = 3").first()["s"] == "b" and back.filter("k = 200").first()["m"] == 0
    after = V.files(spark, root, V.head(spark, root)).collect()
    assert {r["part"] for r in after if r["path"] not in before} == {'{"m":"0"}', '{"m":"3"}'}


def test_newer_than_independent_of_session_zone(spark):
    from datetime import datetime
    df = spark.createDataFrame([(datetime(2020, 1, 1),), (datetime(2020, 1, 1, 5),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert newer_than(df, "ts", datetime(2020, 1, 1)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
