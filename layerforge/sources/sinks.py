"""Sinks: truncate-and-load, versioned snapshots, ops tables.

Plain parquet has no MERGE and no atomic replace, and overwriting a path
that the same plan reads deletes the input first. So a table is a folder of
immutable versions ``<table>/v=<version>/`` plus numbered pointer files
``<table>/_versions/<number>.json`` of which the last names the live version. A
new version is written next to the old one and its pointer file is created only
after the write succeeded, exclusively: of two writers that started from one
version, one gets the number and the other a ``Conflict``. Readers resolve the
pointer, so a failed or lost job leaves the previous version live, and an upsert
can read version N while writing N+1. Tables that are merged by partition or file
have a manifest a version instead (``sources.versions``); ``read_current`` reads
both kinds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import exclusive
from .exclusive import Conflict

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("run_type", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("records_read", T.LongType(), True),
    T.StructField("records_inserted", T.LongType(), True),
    T.StructField("records_updated", T.LongType(), True),
    T.StructField("records_skipped", T.LongType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("run_timestamp", T.TimestampNTZType(), False),
    T.StructField("duration_seconds", T.DoubleType(), True),
    # rows actually read for the table in this run (raw rows for full loads
    # and dimension refreshes, delta rows for merges); records_read keeps the
    # warehouse meaning, which for merges is the post-merge row count
    T.StructField("source_rows", T.LongType(), True),
])


#: Of the tables' files: a quarter smaller than snappy's on raw text.
CODEC = "zstd"


def write_full(df: DataFrame, path: str, partition_by: list[str] | None = None,
               sort_within: list[str] | None = None) -> None:
    """Truncate-and-load (idempotent): the whole folder is replaced,
    partitions that the new rows lack included, whatever the session's
    partition overwrite mode. Optional month/day partition columns and a sort
    inside each file (clustering) for pruning.

    A partitioned write is rebalanced on its partition columns first: each
    partition is written by as many tasks as its size needs (AQE splits large
    ones), not by every task of the stage.
    """
    writer = (layout(df, partition_by, sort_within).write.mode("overwrite").option("partitionOverwriteMode", "static")
              .option("compression", CODEC))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def layout(df: DataFrame, partition_by: list[str] | None = None, sort_within: list[str] | None = None) -> DataFrame:
    """Rows laid out for a write: rebalanced on the partition columns, sorted
    by them and the clustering columns within each task."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_within)
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever file system it names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _pointer(root: str, seq: int) -> str:
    return f"{root}/_versions/{seq:012d}.json"


def _seqs(spark: SparkSession, root: str) -> list[int]:
    return [int(n.split(".")[0]) for n in exclusive.names(spark, f"{root}/_versions")]


def _pointer_rows(spark: SparkSession, root: str) -> list[dict]:
    """All pointer rows of a table, oldest first: seq, version, folder, and for
    one that took another back, undoes."""
    return [exclusive.load(spark, _pointer(root, n)) for n in _seqs(spark, root)]


def _not_undone(spark: SparkSession, root: str) -> list[dict]:
    """Pointer rows of versions that were written and not taken back."""
    rows = _pointer_rows(spark, root)
    undone = {r["undoes"] for r in rows if "undoes" in r}
    return [r for r in rows if r["seq"] not in undone and "undoes" not in r]


def was_live(spark: SparkSession, root: str, version: str) -> bool:
    """Whether the version was live once and was not taken back."""
    return any(r["version"] == version for r in _not_undone(spark, root))


def _live(spark: SparkSession, root: str) -> dict | None:
    seqs = _seqs(spark, root)
    return exclusive.load(spark, _pointer(root, seqs[-1])) if seqs else None


def is_versioned(spark: SparkSession, root: str) -> bool:
    """Whether the table has a manifest a version (``sources.versions``)."""
    return path_exists(spark, f"{root}/_commits")


def current_version(spark: SparkSession, root: str) -> str | None:
    if is_versioned(spark, root):
        from . import versions
        return versions.head(spark, root).version
    row = _live(spark, root)
    return row["version"] if row else None


def refuse_known(spark: SparkSession, root: str, version: str) -> tuple[int, str]:
    """A version that was live once is not written again, unless it was taken
    back: the live one would be overwritten while it is read, an older one would
    bring old rows back. Returns the number that the write may claim, and the
    version's folder."""
    rows, kept = _pointer_rows(spark, root), _not_undone(spark, root)
    if any(r["version"] == version for r in kept):
        what = "live" if rows[-1]["version"] == version else "superseded"
        raise ValueError(f"version {version} of {root} is {what}; write a new version")
    again = sum(r["version"] == version and "undoes" not in r for r in rows)
    return (rows[-1]["seq"] + 1 if rows else 0), f"v={version}" + (f"+{again}" if again else "")


def move_pointer(spark: SparkSession, root: str, seq: int, version: str, folder: str, **more) -> None:
    """Make a version the live one, as number ``seq``. A crash before this leaves
    the earlier version live, never none; a number that another writer has taken
    meanwhile is a ``Conflict``, and the version written is not live."""
    if not exclusive.create_once(spark, _pointer(root, seq), {"seq": seq, "version": version, "folder": folder, **more}):
        raise Conflict(f"{root}: another writer committed number {seq} before {version}")


def write_snapshot(df: DataFrame, root: str, version: str, **kw) -> str:
    """Write a new version, then move the pointer; returns its path."""
    seq, folder = refuse_known(df.sparkSession, root, version)
    write_full(df, f"{root}/{folder}", **kw)
    move_pointer(df.sparkSession, root, seq, version, folder)
    return f"{root}/{folder}"


def restore(spark: SparkSession, root: str, version: str) -> str:
    """Take back the live version ``version``: the one before it becomes live
    again, and ``version`` may be written anew. Returns the version restored."""
    rows = _pointer_rows(spark, root)
    if not rows or rows[-1]["version"] != version:
        raise ValueError(f"{version} is not the live version of {root}")
    *before, live = _not_undone(spark, root)
    if not before:
        raise ValueError(f"{version} is the first version of {root}")
    move_pointer(spark, root, rows[-1]["seq"] + 1, before[-1]["version"], before[-1]["folder"], undoes=live["seq"])
    return before[-1]["version"]


def current_path(spark: SparkSession, root: str) -> str:
    """Folder of the live version."""
    row = _live(spark, root)
    if row is None:
        raise FileNotFoundError(f"no live version under {root}")
    return f"{root}/{row['folder']}"


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """Scan of the live version of a table."""
    if is_versioned(spark, root):
        from . import versions
        return versions.read(spark, root)
    return spark.read.parquet(current_path(spark, root))


def read_previous(spark: SparkSession, root: str) -> DataFrame | None:
    """Scan of the version before the live one, if there is one."""
    if is_versioned(spark, root):
        from . import versions
        commits = versions.history(spark, root)
        return versions.scan(spark, root, commits[-2]) if len(commits) > 1 else None
    seqs = _seqs(spark, root)
    return spark.read.parquet(f"{root}/{exclusive.load(spark, _pointer(root, seqs[-2]))['folder']}") if len(seqs) > 1 else None


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Create an empty table with a fixed schema if absent; returns True
    when it was created."""
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return True


def ensure_ops_tables(spark: SparkSession, ops_root: str) -> dict[str, bool]:
    from ..operators.quality import DQ_SCHEMA
    return {"pipeline_run_log": ensure_table(spark, f"{ops_root}/pipeline_run_log", RUN_LOG_SCHEMA),
            "dq_results": ensure_table(spark, f"{ops_root}/dq_results", DQ_SCHEMA)}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a fixed schema; absent nullable columns become
    NULL, a missing NOT NULL value fails the write."""
    cols = []
    for f in schema.fields:
        c = (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}")).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def append_log(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows to an ops log with its declared schema."""
    conform(df, schema).write.mode("append").parquet(path)
