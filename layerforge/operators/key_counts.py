"""Row counts by key, kept up to date from what changed (Q3, Q4 on deltas).

Uniqueness and foreign keys are facts about whole tables, but a batch changes few
keys. The counts are a versioned table of their own (the keys, ``cnt``, and a
bucket by hash, its partition), whose version is named after the version of the
table that it counts. To bring it up to date, the keys of the files that only one of
the two versions has are reduced to a net count by key (partial sums before the
shuffle, so a key with a third of the changes is a row a task), the buckets that it touches are merged, and
one commit exchanges their files. Neither the table's unchanged files nor the
other buckets are read.

A check of the batch then reads the counts: narrow rows, one a key, instead of the
tables' rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import work_root
from ..sources import versions as V
from .quality import foreign_key_of_counts, unique_of_counts

BUCKET = "_bucket"


def _bucketed(counts: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return counts.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def refresh(spark: SparkSession, root: str, counts_root: str, keys: Sequence[str], buckets: int = 64) -> V.Commit:
    """Bring the counts of ``root`` by ``keys`` to its live version; does nothing
    if they are there. A lost or concurrent refresh leaves the counts as they
    were (a second one of the same version is a ``Conflict``)."""
    keys = list(keys)
    now, known = V.head(spark, root), V.head(spark, counts_root)
    if known is None:
        rows = V.scan(spark, root, now).groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
        return V.replace(_bucketed(rows, keys, buckets), counts_root, str(now.seq), [BUCKET])
    if int(known.version) == now.seq:
        return known
    old = V.at_number(spark, root, int(known.version))
    work_root(spark)
    net = _bucketed(V.key_changes(spark, root, old, now, keys), keys, buckets).checkpoint(eager=True)
    touched = net.select(V.part_key([BUCKET]).alias("part")).distinct()
    files = V.files(spark, counts_root, known)
    hit = files.join(touched, "part", "left_semi").select(*files.columns).checkpoint(eager=True)
    merged = (V.scan(spark, counts_root, known, hit).unionByName(net)
              .groupBy(*keys, BUCKET).agg(F.sum("cnt").alias("cnt")).filter("cnt <> 0"))
    schema = known.struct()
    attempt, added = V.write_files(merged.select(*schema.names), counts_root, [BUCKET])
    return V.commit(spark, counts_root, str(now.seq), "refresh", schema, [BUCKET], known, added, hit, attempt)


def read(spark: SparkSession, counts_root: str) -> DataFrame:
    """The keys and ``cnt``, the number of rows that have them."""
    return V.read(spark, counts_root).drop(BUCKET)


def check_unique(spark: SparkSession, counts_root: str, keys: Sequence[str], id_col: str | None = None) -> DataFrame:
    """``quality.check_unique`` of the table that is counted."""
    return unique_of_counts(read(spark, counts_root), list(keys), id_col)


def check_foreign_key(spark: SparkSession, child_counts: str, parent_counts: str, key: str) -> DataFrame:
    """``quality.check_foreign_key`` from the counts of child and parent. Both are as
    long as their tables have keys, but so narrow and so well compressed that their
    files can be under the broadcast threshold, and then the driver would build the
    hash table of all keys. They are sorted and merged: a key is a row on each side."""
    return foreign_key_of_counts(read(spark, child_counts), read(spark, parent_counts).hint("merge"), key)
