"""Versioned tables on plain parquet: immutable files, a manifest a version, and
commits that one writer wins.

    <root>/data/_v=<attempt>/[<partition>=<value>/]part-*.parquet
    <root>/_manifests/<attempt>/part-*.parquet      the files of a version, a row each
    <root>/_commits/<number>.json                   the version itself

A write puts new files into a folder of its own attempt, writes the manifest of
the version to be (files that are carried over, and the new ones), and commits by
creating the file of the next number. Nothing that is live is renamed,
overwritten or deleted, so a job or a driver lost at any point leaves the version
before it whole; what it left behind is in no manifest and is never read.

Two writers may start from the same version. One gets the number; the other looks
at what was committed meanwhile and either rebases (its own files are still
live, and nothing new concerns its keys) or raises ``Conflict``.

Manifests are DataFrames, and so is all work on them: carrying files over is an
anti join, the difference of two versions reads only the files that are in one of
them, and what may be removed is an anti join with the manifests in use. The
driver gets the commit that is read and the paths of the files to scan, whole
folders as one path, as for any parquet table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import exclusive
from .exclusive import Conflict
from .sinks import CODEC, layout

ATTEMPT = "_v"
MANIFEST = "path string, folder string, folder_files long, part string, rows long, bytes long"


@dataclass(frozen=True)
class Commit:
    seq: int
    attempt: str
    version: str                    # the writer's name for it, such as a batch id
    operation: str
    base: int | None
    at: str                         # UTC, ISO
    schema: str
    partition_by: tuple[str, ...]

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _name(root: str, seq: int) -> str:
    return f"{root}/_commits/{seq:012d}.json"


def _load(spark: SparkSession, root: str, seq: int) -> Commit:
    d = exclusive.load(spark, _name(root, seq))
    return Commit(**d | {"partition_by": tuple(d["partition_by"])})


def at_number(spark: SparkSession, root: str, seq: int) -> Commit:
    return _load(spark, root, seq)


def numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n.split(".")[0]) for n in exclusive.names(spark, f"{root}/_commits")]


def history(spark: SparkSession, root: str) -> list[Commit]:
    """All commits, oldest first."""
    return [_load(spark, root, n) for n in numbers(spark, root)]


def head(spark: SparkSession, root: str) -> Commit | None:
    n = numbers(spark, root)
    return _load(spark, root, n[-1]) if n else None


def find(spark: SparkSession, root: str, version: str | None = None, as_of: datetime | None = None) -> Commit:
    """The live version; the last one named ``version``; or the one that was live
    at ``as_of`` (UTC, without a zone)."""
    if version is None and as_of is None:
        found = head(spark, root)
    else:
        limit = as_of.isoformat(timespec="microseconds") if as_of else None
        found = next((c for c in reversed(history(spark, root))
                      if (version is None or c.version == version) and (limit is None or c.at <= limit)), None)
    if found is None:
        raise FileNotFoundError(f"no such version of {root}")
    return found


# ---------------------------------------------------------------- reading

def files(spark: SparkSession, root: str, commit: Commit) -> DataFrame:
    """The manifest of a version."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/_manifests/{commit.attempt}")


def scan(spark: SparkSession, root: str, commit: Commit, chosen: DataFrame | None = None, with_path: bool = False,
         schema: T.StructType | None = None) -> DataFrame:
    """The rows of a version, or of its files ``chosen`` (manifest rows); with
    ``_path``, the path of a row's file in the manifest. Files that were written
    under an earlier schema give NULL for the columns they lack, and narrower
    numbers are widened by the parquet reader."""
    schema = schema or commit.struct()
    rows = files(spark, root, commit) if chosen is None else chosen
    # a folder all of whose files are wanted is one path
    paths = (rows.groupBy("folder").agg((F.count(F.lit(1)) == F.first("folder_files")).alias("whole"), F.collect_list("path").alias("paths"))
                 .select(F.explode(F.when(F.col("whole"), F.array("folder")).otherwise(F.col("paths")))).collect())
    cols = [F.col(f"`{c}`") for c in schema.names]
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("_path", F.lit("")) if with_path else empty
    found = _open(spark, root, schema, [f"{root}/data/{p[0]}" for p in sorted(paths)])
    return found.select(*cols, *([_path().alias("_path")] if with_path else []))


def _path():
    """The path of a row's file below ``data``."""
    return F.substring_index(F.col("_metadata.file_path"), "/data/", -1)


def _open(spark: SparkSession, root: str, schema: T.StructType, paths: list[str]) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])
    return spark.read.schema(whole).option("basePath", f"{root}/data").parquet(*paths)


def read(spark: SparkSession, root: str, version: str | None = None, as_of: datetime | None = None) -> DataFrame:
    return scan(spark, root, find(spark, root, version, as_of))


#: What a type may become without a value changing.
_WIDER = {"byte": {"short", "integer", "long", "double"}, "short": {"integer", "long", "double"}, "integer": {"long", "double"},
          "float": {"double"}, "date": {"timestamp_ntz"}}


class IncompatibleSchema(RuntimeError):
    """A column whose types in two versions have no common wider one."""


def merged_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """All columns of both, in the order of their first place, nullable where one
    of the two lacks them, each in the wider of its types."""
    def wider(x: T.StructField, y: T.StructField) -> T.StructField:
        s, t = x.dataType, y.dataType
        nullable = x.nullable or y.nullable
        if s == t or s.typeName() in _WIDER.get(t.typeName(), ()):
            return T.StructField(x.name, s, nullable)
        if t.typeName() in _WIDER.get(s.typeName(), ()):
            return T.StructField(x.name, t, nullable)
        if isinstance(s, T.DecimalType) and isinstance(t, T.DecimalType):
            scale, whole = max(s.scale, t.scale), max(s.precision - s.scale, t.precision - t.scale)
            if scale + whole <= 38:
                return T.StructField(x.name, T.DecimalType(scale + whole, scale), nullable)
        raise IncompatibleSchema(f"{x.name}: {s.simpleString()} and {t.simpleString()}")

    left, right = {f.name: f for f in a.fields}, {f.name: f for f in b.fields}
    out = [wider(f, right[f.name]) if f.name in right else T.StructField(f.name, f.dataType, True) for f in a.fields]
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name not in left])


def read_versions(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """The rows of several versions as one table, with ``_version``: columns that
    a version lacks are NULL, types are the widest of all."""
    commits = [find(spark, root, n) for n in names]
    schema = commits[0].struct()
    for c in commits[1:]:
        schema = merged_schema(schema, c.struct())
    out = None
    for c in commits:
        own = scan(spark, root, c).withColumn("_version", F.lit(c.version))
        for f in schema.fields:
            have = F.col(f"`{f.name}`") if f.name in c.struct().names else F.lit(None)
            own = own.withColumn(f.name, have.cast(f.dataType))
        own = own.select(*[f"`{n}`" for n in schema.names], "_version")
        out = own if out is None else out.unionByName(own)
    return out


def part_key(partition_by: Sequence[str]):
    """The partition of a row as the manifest names it."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by])) if partition_by else F.lit("{}")


# ---------------------------------------------------------------- writing

def write_files(df: DataFrame, root: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] | None = None
                ) -> tuple[str, DataFrame]:
    """Write rows as new files of one attempt; returns its name and manifest
    rows. Files without rows are not in the manifest."""
    spark, attempt = df.sparkSession, uuid.uuid4().hex
    writer = layout(df, list(partition_by) or None, list(sort_within) if sort_within else None).write.option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/data/{ATTEMPT}={attempt}")
    back = _open(spark, root, df.schema, [f"{root}/data/{ATTEMPT}={attempt}"])
    # row counts come from the footers: no column is read, and what names a file is made once a file, not once a row
    found = (back.groupBy(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("bytes"), *partition_by)
                 .agg(F.count(F.lit(1)).alias("rows"))
                 .select(F.substring_index("_file", "/data/", -1).alias("path"), "bytes", part_key(partition_by).alias("part"), "rows")
                 .withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1)))
    return attempt, found.select("path", "folder", F.count(F.lit(1)).over(Window.partitionBy("folder")).alias("folder_files"),
                                 "part", "rows", "bytes")


def commit(spark: SparkSession, root: str, version: str, operation: str, schema: T.StructType,
           partition_by: Sequence[str], base: Commit | None, added: DataFrame | None = None,
           removed: DataFrame | None = None, attempt: str | None = None, at: datetime | None = None,
           recheck: Callable[[Commit, DataFrame], bool] | None = None) -> Commit:
    """Commit ``base`` without ``removed`` and with ``added`` (manifest rows).

    If another writer was faster, the commit is tried again on top of theirs: only
    if all of ``removed`` is still live, and ``recheck`` accepts the files that are
    new since ``base``. Without ``recheck`` it raises ``Conflict`` at once.
    """
    attempt = attempt or uuid.uuid4().hex
    none = spark.createDataFrame([], MANIFEST)
    added = none if added is None else added
    while True:
        carried = none if base is None else files(spark, root, base)
        if removed is not None:
            carried = carried.join(removed.select("path"), "path", "left_anti").select(none.columns)
        name = attempt if base is None else f"{attempt}-{base.seq + 1}"
        carried.unionByName(added).coalesce(16).write.mode("overwrite").parquet(f"{root}/_manifests/{name}")
        moment = at or datetime.now(timezone.utc).replace(tzinfo=None)
        entry = Commit(base.seq + 1 if base else 0, name, version, operation, base.seq if base else None,
                       max(moment.isoformat(timespec="microseconds"), base.at if base else ""), schema.json(), tuple(partition_by))
        if exclusive.create_once(spark, _name(root, entry.seq), asdict(entry)):
            return entry
        now = head(spark, root)
        if recheck is None:
            raise Conflict(f"{root}: version {now.seq} ({now.version}) was committed by another writer")
        theirs = files(spark, root, now)
        if removed is not None and not removed.join(theirs, "path", "left_anti").isEmpty():
            raise Conflict(f"{root}: files that {version} rewrites were rewritten by {now.version}")
        new = theirs if base is None else theirs.join(files(spark, root, base).select("path"), "path", "left_anti")
        if now.schema != entry.schema or not recheck(now, new.select(none.columns)):
            raise Conflict(f"{root}: {now.version} committed rows that concern {version}")
        base = now


def replace(df: DataFrame, root: str, version: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] | None = None,
            base: Commit | None = None, at: datetime | None = None) -> Commit:
    """A version that consists of ``df`` alone. ``base`` is the version that the
    caller looked at (by default the live one); a newer one is a conflict."""
    spark = df.sparkSession
    base = base or head(spark, root)
    attempt, added = write_files(df, root, partition_by, sort_within)
    removed = files(spark, root, base) if base else None
    return commit(spark, root, version, "replace", df.schema, partition_by, base, added, removed, attempt, at)


def append(df: DataFrame, root: str, version: str, at: datetime | None = None, evolve: bool = False) -> Commit:
    """Add rows to the live version; other writers' commits do not matter. With
    ``evolve``, columns that are new or wider change the schema from this version
    on, without a file being rewritten; columns that ``df`` lacks are NULL."""
    spark, base = df.sparkSession, head(df.sparkSession, root)
    schema = merged_schema(base.struct(), df.schema) if evolve else base.struct()
    rows = df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns or not evolve else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])
    attempt, added = write_files(rows, root, base.partition_by)
    return commit(spark, root, version, "append", schema, base.partition_by, base, added, None, attempt, at,
                  recheck=lambda now, new: True)


def compact(spark: SparkSession, root: str, small_bytes: int = 64 << 20, target_bytes: int = 256 << 20,
            at: datetime | None = None) -> Commit:
    """Rewrite files below ``small_bytes`` into files of about ``target_bytes``,
    partition by partition; the rows stay what they are. Appends go on meanwhile:
    the commit is tried again on top of them, and only a writer that rewrote one of
    the same files is a ``Conflict``. A partition with a single small file is left
    as it is."""
    base = head(spark, root)
    listed = files(spark, root, base).filter(F.col("bytes") < small_bytes)
    many = listed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("part")
    chosen = listed.join(many, "part", "left_semi").select(*listed.columns).checkpoint(eager=True)
    total = chosen.agg(F.sum("bytes")).first()[0]
    if not total:
        return base
    rows = scan(spark, root, base, chosen)
    n = max(1, -(-total // target_bytes))
    if base.partition_by:
        attempt, added = write_files(rows, root, base.partition_by)      # rebalanced by partition
    else:
        attempt, added = write_files(rows.coalesce(n) if n < 64 else rows.repartition(n), root)
    return commit(spark, root, f"compact {base.seq}", "compact", base.struct(), base.partition_by, base, added, chosen, attempt, at,
                  recheck=lambda now, new: True)


# ------------------------------------------------- differences and their undo

def _only_in(spark: SparkSession, root: str, a: Commit, b: Commit, schema: T.StructType) -> DataFrame:
    """Rows of the files of ``a`` that ``b`` does not have."""
    chosen = files(spark, root, a).join(files(spark, root, b).select("path"), "path", "left_anti")
    return scan(spark, root, a, chosen.select("path", "folder", "folder_files"), schema=schema)


def _net(plus: DataFrame, minus: DataFrame) -> DataFrame:
    """The distinct rows and ``_n``, how many more there are in ``plus``; rows
    that are as often in both are left out. Rows are compared in all columns,
    with NULL equal to NULL; sums are partial before the shuffle."""
    cols = plus.columns
    both = plus.withColumn("_n", F.lit(1)).unionByName(minus.select(cols).withColumn("_n", F.lit(-1)))
    return both.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum("_n").alias("_n")).filter("_n <> 0")


def changes(spark: SparkSession, root: str, old: Commit, new: Commit, keys: Sequence[str]) -> DataFrame:
    """What turns ``old`` into ``new``: rows with ``_change`` (``insert``,
    ``delete``, ``before`` and ``after`` of an update). Files that both versions
    have are not read. Rows with a NULL key are inserted or deleted, never updated;
    a row that changed n times over is there n times."""
    schema = merged_schema(old.struct(), new.struct())
    net = _net(_only_in(spark, root, new, old, schema), _only_in(spark, root, old, new, schema))
    cols = [c for c in net.columns if c != "_n"]
    keyed = net.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    sides = keyed.groupBy(*keys).agg((F.max("_n") > 0).alias("_new"), (F.min("_n") < 0).alias("_old"))
    both = sides.filter("_new AND _old").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(True).alias("_both"))
    cond = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    out = net.join(both, cond, "left")
    kind = (F.when(F.col("_both") & (F.col("_n") > 0), "after").when(F.col("_both"), "before")
             .when(F.col("_n") > 0, "insert").otherwise("delete"))
    return out.select(*[F.col(f"`{c}`") for c in cols], kind.alias("_change"),
                      F.explode(F.array_repeat(F.lit(0), F.abs("_n").cast("int"))).alias("_")).drop("_")


def key_changes(spark: SparkSession, root: str, old: Commit, new: Commit, keys: Sequence[str]) -> DataFrame:
    """The keys (NULL among them) and ``cnt``, how many more rows have them in
    ``new`` than in ``old``, if not as many. Rows that both versions have cancel
    out by their keys alone, so no other column is read or shuffled."""
    schema = merged_schema(old.struct(), new.struct())
    side = lambda a, b, n: _only_in(spark, root, a, b, schema).select(*keys, F.lit(n).alias("_n"))
    return side(new, old, 1).unionByName(side(old, new, -1)).groupBy(*keys).agg(F.sum("_n").alias("cnt")).filter("cnt <> 0")


def undo(spark: SparkSession, root: str, version: str, keys: Sequence[str], at: datetime | None = None) -> Commit:
    """Take back the last commit named ``version``: inserted rows go, updated rows
    get their earlier image, deleted ones return.

    If it is the live version, the manifest before it becomes live again, and no
    row is read. Otherwise its inverse is applied to the live version: only files
    that hold a key to be taken back are rewritten. A row that a later version
    changed again is a ``Conflict``, found before anything is committed.
    """
    target = find(spark, root, version)
    if target.base is None:
        raise ValueError(f"{version} is the first version of {root}")
    before, now = _load(spark, root, target.base), head(spark, root)
    name = f"undo {version}"
    if now.seq == target.seq:
        return commit(spark, root, name, "undo", before.struct(), before.partition_by, now,
                      files(spark, root, before).join(files(spark, root, now).select("path"), "path", "left_anti"),
                      files(spark, root, now).join(files(spark, root, before).select("path"), "path", "left_anti"), at=at)
    take = changes(spark, root, before, target, keys).checkpoint()
    gone = take.filter("_change IN ('insert', 'after')").drop("_change")
    back = take.filter("_change IN ('before', 'delete')").drop("_change")
    rows = scan(spark, root, now, with_path=True)
    same = lambda a, b: [a[k].eqNullSafe(b[k]) for k in keys]
    gone_keys = gone.select(*keys).distinct()
    hit = rows.select(*keys, "_path").join(gone_keys, same(rows, gone_keys), "left_semi").select(F.col("_path").alias("path")).distinct()
    chosen = files(spark, root, now).join(hit, "path", "left_semi").select(*files(spark, root, now).columns).checkpoint()
    net = _net(scan(spark, root, now, chosen).unionByName(back), gone).checkpoint()
    if not net.filter("_n < 0").isEmpty():
        raise Conflict(f"{root}: rows of {version} were changed again by a later version")
    left = net.select(*[F.col(f"`{c}`") for c in rows.columns if c != "_path"],
                      F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int"))).alias("_")).drop("_")
    attempt, added = write_files(left, root, now.partition_by)
    return commit(spark, root, name, "undo", now.struct(), now.partition_by, now, added, chosen, attempt, at)


# -------------------------------------------------------------- retention

def retained(spark: SparkSession, root: str, now: datetime, days: int = 90) -> list[Commit]:
    """Versions that must stay readable: the live one however old, the one before
    it, and all that were live at some time of the last ``days`` days."""
    from datetime import timedelta
    all_, cutoff = history(spark, root), (now - timedelta(days=days)).isoformat(timespec="microseconds")
    live_at_cutoff = [c for c in all_ if c.at <= cutoff][-1:]
    keep = {c.seq for c in [*all_[-2:], *live_at_cutoff, *(c for c in all_ if c.at > cutoff)]}
    return [c for c in all_ if c.seq in keep]


def removable(spark: SparkSession, root: str, now: datetime, days: int = 90) -> DataFrame:
    """Files that no retained version has: path, rows, bytes, and the newest
    version that had it. Removing them stays a step of the operator."""
    keep = retained(spark, root, now, days)
    kept = {c.seq for c in keep}
    old = [c for c in history(spark, root) if c.seq not in kept]
    if not old:
        return spark.createDataFrame([], "path string, rows long, bytes long, last_seq long")
    listed = lambda cs: spark.read.schema(MANIFEST).option("basePath", f"{root}/_manifests").parquet(
        *[f"{root}/_manifests/{c.attempt}" for c in cs])
    seqs = spark.createDataFrame([(c.attempt, c.seq) for c in old], "attempt string, seq long")
    named = listed(old).withColumn("attempt", F.regexp_extract("_metadata.file_path", "/_manifests/([^/]*)/", 1))
    return (named.join(seqs, "attempt").groupBy("path", "rows", "bytes").agg(F.max("seq").alias("last_seq"))
                 .join(listed(keep).select("path"), "path", "left_anti"))
