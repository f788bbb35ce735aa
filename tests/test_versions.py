"""Versioned tables: commits, interrupted and concurrent writers, differences,
undo, as-of reads, retention."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from layerforge import RunContext
from layerforge.context import new_run_dir
from layerforge.operators.upsert import upsert_files, upsert_partitions
from layerforge.sources import exclusive as E
from layerforge.sources import versions as V

B2, B3 = RunContext(batch_id="b2"), RunContext(batch_id="b3")


def local(path):
    return path.removeprefix("file:")


def people(spark, n=100, parts=10):
    return spark.range(n).select(F.col("id").alias("k"), F.lit("a").alias("s"), (F.col("id") % parts).alias("m"))


def table(spark, n=100, parts=10):
    root = new_run_dir(spark, "versions")
    V.replace(people(spark, n, parts), root, "b1", ["m"])
    return root


def source(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, s string")


def by_ten(df):
    return F.col("k") % 10


def rows_of(df):
    return sorted(map(tuple, df.select("k", "s", "m").collect()), key=str)


def data_files(root):
    return {f: os.path.getmtime(f) for f in glob.glob(local(root) + "/data/**/*.parquet", recursive=True)}


def test_one_writer_creates_a_file(spark):
    root = new_run_dir(spark, "claims")
    assert E.create_once(spark, f"{root}/c/1.json", {"a": "ä"}) and not E.create_once(spark, f"{root}/c/1.json", {"a": 2})
    assert E.names(spark, f"{root}/c") == ["1.json"] and E.load(spark, f"{root}/c/1.json") == {"a": "ä"}
    assert E.names(spark, f"{root}/none") == []


def test_partitions_that_are_not_touched_are_carried_over(spark):
    root = table(spark)
    before = data_files(root)
    r = upsert_partitions(spark, root, source(spark, (3, "b"), (200, "c"), (13, "a")), "k", "s", ["s"], B2, "m", by_ten)
    assert {k: r[k] for k in ("partitions", "inserted", "updated", "kept")} == {
        "partitions": [0, 3], "inserted": 1, "updated": 1, "kept": 19}
    now = data_files(root)
    assert before.items() <= now.items()                       # nothing live was renamed or rewritten in place
    old, new = V.history(spark, root)
    mine = V.files(spark, root, new)
    carried = mine.join(V.files(spark, root, old), "path", "left_semi")
    assert {r["part"] for r in mine.join(V.files(spark, root, old), "path", "left_anti").collect()} == {'{"m":"0"}', '{"m":"3"}'}
    assert {r["part"] for r in carried.collect()} == {f'{{"m":"{k}"}}' for k in (1, 2, 4, 5, 6, 7, 8, 9)}
    back = V.read(spark, root)
    assert back.count() == 101 and back.filter("k = 3").first()["s"] == "b" and back.filter("k = 200").first()["m"] == 0


class Lost(RuntimeError):
    pass


def test_a_merge_lost_before_its_commit_leaves_the_old_version_whole(spark, monkeypatch):
    root = table(spark)
    want = rows_of(V.read(spark, root))
    src = source(spark, *[(k, "z") for k in range(0, 100, 2)])

    def lost(*a, **kw):
        raise Lost

    monkeypatch.setattr(V, "commit", lost)                     # all folders written, driver lost
    with pytest.raises(Lost):
        upsert_partitions(spark, root, src, "k", "s", ["s"], B2, "m", by_ten)
    monkeypatch.undo()
    # a job that fails after part of its tasks wrote their folders
    poison = src.withColumn("s", F.when(F.col("k") == 98, F.raise_error(F.lit("task lost")).cast("string")).otherwise(F.col("s")))
    with pytest.raises(Exception):
        V.write_files(poison.withColumn("m", by_ten(poison)).select("k", "s", "m"), root, ["m"])
    assert rows_of(V.read(spark, root)) == want and V.head(spark, root).version == "b1"
    r = upsert_partitions(spark, root, src, "k", "s", ["s"], B2, "m", by_ten)          # the retry sees nothing of it
    assert (r["updated"], r["inserted"]) == (50, 0)
    assert V.read(spark, root).groupBy("s").count().filter("s = 'z'").first()["count"] == 50


def test_copy_on_write_rewrites_matched_files_only(spark):
    root = new_run_dir(spark, "files")
    V.replace(people(spark, 1000).repartitionByRange(8, "k"), root, "b1")
    r = upsert_files(spark, root, source(spark, (5, "b"), (6, "b"), (5000, "new")).withColumn("m", F.lit(1).cast("long")),
                     "k", "s", ["s"], B2)
    old, new = V.history(spark, root)
    gone = V.files(spark, root, old).join(V.files(spark, root, new), "path", "left_anti")
    assert (r["inserted"], r["updated"], r["files_rewritten"], gone.count()) == (1, 2, 1, 1)
    assert V.files(spark, root, new).join(V.files(spark, root, old), "path", "left_semi").count() == 7
    assert V.read(spark, root).count() == 1001 and V.read(spark, root).filter("s = 'b'").count() == 2


def test_files_without_a_match_are_read_for_keys_only(spark):
    root = new_run_dir(spark, "files")
    V.replace(people(spark, 1000).repartitionByRange(8, "k"), root, "b1")
    c = V.head(spark, root)
    keys = V.scan(spark, root, c, with_path=True).select("k", "_path")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint>" in keys
    hit = V.files(spark, root, c).limit(1)
    plan = V.scan(spark, root, c, hit)._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan


def test_null_partitions_null_keys_and_empty_sources(spark):
    root = new_run_dir(spark, "nulls")
    t = spark.createDataFrame([(1, "a", None), (None, "n", 2), (3, "a", 3)], "k long, s string, m long")
    V.replace(t, root, "b1", ["m"])
    none = lambda df: F.when(F.col("k") != 1, F.col("k"))
    r = upsert_partitions(spark, root, source(spark, (1, "b"), (None, "q")), "k", "s", ["s"], B2, "m", none)
    assert (r["inserted"], r["updated"], r["partitions"]) == (1, 1, [None])
    assert rows_of(V.read(spark, root)) == sorted([(1, "b", None), (None, "n", 2), (3, "a", 3), (None, "q", None)], key=str)
    before = rows_of(V.read(spark, root))
    r = upsert_files(spark, root, source(spark), "k", "s", ["s"], B3, "m", none)
    assert (r["inserted"], r["updated"], r["files_rewritten"]) == (0, 0, 0)
    assert rows_of(V.read(spark, root)) == before and V.head(spark, root).version == "b3"


def test_empty_table_and_repeated_source_key(spark):
    root = new_run_dir(spark, "empty")
    V.replace(people(spark, 0), root, "b1", ["m"])
    assert V.read(spark, root).count() == 0
    with pytest.raises(Exception):
        upsert_files(spark, root, source(spark, (1, "a"), (1, "b")), "k", "s", ["s"], B2, "m", by_ten)
    assert V.head(spark, root).version == "b1"
    upsert_files(spark, root, source(spark, (1, "a"), (2, "b")), "k", "s", ["s"], B2, "m", by_ten)
    assert rows_of(V.read(spark, root)) == [(1, "a", 1), (2, "b", 2)]


def between(monkeypatch, action):
    """Run ``action`` once, after the next merge wrote its files and before it commits."""
    real = V.write_files

    def slow(*a, **kw):
        out = real(*a, **kw)
        monkeypatch.setattr(V, "write_files", real)
        action()
        return out
    monkeypatch.setattr(V, "write_files", slow)


def test_concurrent_merges_of_different_keys_are_both_kept(spark, monkeypatch):
    root = table(spark)
    between(monkeypatch, lambda: upsert_partitions(spark, root, source(spark, (4, "x"), (204, "n")), "k", "s", ["s"], B2, "m", by_ten))
    r = upsert_partitions(spark, root, source(spark, (3, "y"), (203, "n")), "k", "s", ["s"], B3, "m", by_ten)
    assert [c.version for c in V.history(spark, root)] == ["b1", "b2", "b3"] and r["commit"].base == 1
    got = {t[0]: t[1] for t in rows_of(V.read(spark, root))}
    assert (got[3], got[4], got[203], got[204], len(got)) == ("y", "x", "n", "n", 102)


@pytest.mark.parametrize("mine", [(4, "y"), (204, "m")])
def test_concurrent_merges_of_the_same_rows_conflict(spark, monkeypatch, mine):
    """Rewritten by both, or inserted by both: the second writer is told, and
    the first one's rows stay."""
    root = table(spark)
    between(monkeypatch, lambda: upsert_files(spark, root, source(spark, (4, "x"), (204, "n")), "k", "s", ["s"], B2, "m", by_ten))
    with pytest.raises(V.Conflict):
        upsert_files(spark, root, source(spark, mine), "k", "s", ["s"], B3, "m", by_ten)
    got = {t[0]: t[1] for t in rows_of(V.read(spark, root))}
    assert (got[4], got[204], len(got)) == ("x", "n", 101)


def test_replace_against_a_newer_version_conflicts_and_appends_do_not(spark, monkeypatch):
    root = table(spark)
    between(monkeypatch, lambda: V.append(people(spark, 3).withColumn("k", F.col("k") + 500), root, "b2"))
    V.append(people(spark, 2).withColumn("k", F.col("k") + 600), root, "b3")
    assert V.read(spark, root).count() == 105
    between(monkeypatch, lambda: V.append(people(spark, 1), root, "b4"))
    with pytest.raises(V.Conflict):
        V.replace(people(spark, 1), root, "b5", ["m"])
    assert V.read(spark, root).count() == 106


def diff(df):
    return sorted((r["k"], r["s"], r["_change"]) for r in df.collect())


def test_difference_has_before_images(spark):
    root = table(spark)
    upsert_partitions(spark, root, source(spark, (3, "b"), (200, "c"), (13, "a")), "k", "s", ["s"], B2, "m", by_ten)
    old, new = V.history(spark, root)
    assert diff(V.changes(spark, root, old, new, ["k"])) == [(3, "a", "before"), (3, "b", "after"), (200, "c", "insert")]
    assert diff(V.changes(spark, root, new, old, ["k"])) == [(3, "a", "after"), (3, "b", "before"), (200, "c", "delete")]
    assert diff(V.changes(spark, root, new, new, ["k"])) == []
    plan = V.changes(spark, root, old, new, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(2 paths)" in plan and "InMemoryFileIndex(10 paths)" not in plan


def test_undo_of_the_live_version_and_replay(spark):
    root = table(spark)
    want, src = rows_of(V.read(spark, root)), source(spark, (3, "b"), (200, "c"))
    upsert_partitions(spark, root, src, "k", "s", ["s"], B2, "m", by_ten)
    after = rows_of(V.read(spark, root))
    V.undo(spark, root, "b2", ["k"])
    assert rows_of(V.read(spark, root)) == want
    upsert_partitions(spark, root, src, "k", "s", ["s"], B2, "m", by_ten)
    assert rows_of(V.read(spark, root)) == after


def test_undo_below_a_later_version(spark):
    root = table(spark)
    upsert_files(spark, root, source(spark, (3, "b"), (200, "c"), (None, "q")), "k", "s", ["s"], B2, "m", by_ten)
    upsert_files(spark, root, source(spark, (4, "d"), (13, "e"), (201, "f")), "k", "s", ["s"], B3, "m", by_ten)
    V.undo(spark, root, "b2", ["k"])
    got = {t[0]: t[1] for t in rows_of(V.read(spark, root))}
    assert (got[3], got[4], got[13], got[201], 200 in got, None in got, len(got)) == ("a", "d", "e", "f", False, False, 101)


def test_undo_of_rows_that_changed_again_conflicts(spark):
    root = table(spark)
    upsert_files(spark, root, source(spark, (3, "b")), "k", "s", ["s"], B2, "m", by_ten)
    upsert_files(spark, root, source(spark, (3, "c")), "k", "s", ["s"], B3, "m", by_ten)
    with pytest.raises(V.Conflict):
        V.undo(spark, root, "b2", ["k"])
    assert V.head(spark, root).version == "b3"
    with pytest.raises(ValueError):
        V.undo(spark, root, "b1", ["k"])


def test_as_of_reads_and_retention(spark):
    root, day = new_run_dir(spark, "times"), lambda m, d: datetime(2024, m, d)
    for n, at in enumerate([day(1, 1), day(2, 1), day(3, 1), day(9, 1)], 1):
        V.replace(people(spark, n), root, f"b{n}", at=at)
    count = lambda at: V.read(spark, root, as_of=at).count()
    assert [count(day(1, 1)), count(day(2, 20)), count(day(8, 31)), count(day(12, 1))] == [1, 2, 3, 4]
    with pytest.raises(FileNotFoundError):
        count(datetime(2023, 12, 31))
    kept = lambda at: [c.version for c in V.retained(spark, root, at, 90)]
    assert kept(day(10, 1)) == ["b3", "b4"]                    # b3 was live until September
    assert kept(datetime(2030, 1, 1)) == ["b3", "b4"]          # the live one, however old, and the one before it
    assert kept(day(3, 2)) == ["b1", "b2", "b3", "b4"]
    gone = V.removable(spark, root, day(10, 1)).collect()
    live = {r["path"] for c in V.retained(spark, root, day(10, 1)) for r in V.files(spark, root, c).collect()}
    assert {r["last_seq"] for r in gone} == {0, 1} and not {r["path"] for r in gone} & live
    assert V.removable(spark, root, day(3, 2)).count() == 0


def test_carried_files_are_not_removable(spark):
    root = table(spark)
    for n in range(3):
        upsert_partitions(spark, root, source(spark, (3, f"v{n}")), "k", "s", ["s"], RunContext(batch_id=f"m{n}"), "m", by_ten)
    gone = V.removable(spark, root, datetime(2100, 1, 1)).collect()
    assert len(gone) == 2 and all("/m=3/" in r["path"] for r in gone)
    assert rows_of(V.read(spark, root))[0] is not None and V.read(spark, root).count() == 100


def test_compaction_keeps_rows_while_appends_go_on(spark, monkeypatch):
    root = new_run_dir(spark, "log")
    V.replace(people(spark, 2), root, "b0")
    for n in range(1, 12):
        V.append(people(spark, 2), root, f"b{n}")
    between(monkeypatch, lambda: V.append(people(spark, 3), root, "meanwhile"))
    done = V.compact(spark, root)
    assert done.operation == "compact" and V.read(spark, root).count() == 27
    new = V.files(spark, root, done)
    assert new.count() <= 1 + new.filter("rows = 3 OR rows < 3").count() and new.filter("rows = 24").count() == 1
    again = V.compact(spark, root)
    assert V.files(spark, root, again).count() == 1 and V.read(spark, root).count() == 27
    assert V.compact(spark, root) == again                              # nothing left to do
    assert V.read(spark, root, "b3").count() == 8                       # earlier versions read as before


def test_compaction_against_a_merge_of_the_same_files_conflicts(spark, monkeypatch):
    root = new_run_dir(spark, "log")
    V.replace(people(spark, 4).repartition(3), root, "b1")
    V.append(people(spark, 4).withColumn("k", F.col("k") + 10), root, "b2")
    between(monkeypatch, lambda: upsert_files(spark, root, source(spark, (1, "z")).withColumn("m", F.lit(1).cast("long")), "k", "s", ["s"], B3))
    with pytest.raises(V.Conflict):
        V.compact(spark, root)
    assert V.read(spark, root).filter("s = 'z'").count() == 1 and V.read(spark, root).count() == 8


def test_manifest_rows_come_from_one_scan_and_are_named_once_a_file(spark):
    root = new_run_dir(spark, "manifest")
    _, added = V.write_files(spark.range(1000).withColumn("part", F.col("id") % 3), root, ["part"])
    plan = added._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1                                # the files were scanned twice before
    assert "substring_index" not in plan[plan.rindex("Project ["):]     # not below the aggregate: a file, not a row
    got = added.collect()
    assert sum(r["rows"] for r in got) == 1000 and {r["part"] for r in got} == {f'{{"part":"{i}"}}' for i in range(3)}
    assert all(r["path"].startswith(r["folder"] + "/part-") and r["folder_files"] >= 1 for r in got)
