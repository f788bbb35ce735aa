"""Exact dedup against a persistent digest index (DataFrame functions only).

The index is a parquet table, bucketed and sorted by digest, one row for each
text seen so far.  A batch of documents is hashed, reduced to one row a digest
(partial aggregation runs before the shuffle, so a group of copies costs one
row for each input partition), and sort-merge anti-joined with the index.  The
index side of that join needs no shuffle: a task reads its bucket's files and
sorts them (each file is sorted, but a bucket has one from every batch).  What is
new is appended.

Retry
-----
Every index row names the batch that brought it.  A batch that is ingested again
under its own name (after a crash between the append and the caller's own write)
gets the decisions that it got the first time: its own rows do not count as
known, and digests that it has appended already are not appended again.

Decisions
---------
* Texts are equal if they are identical after every character of
  ``[\\x20\\x09-\\x0D]`` is deleted; a null text counts as empty.
* Of equal texts within a batch the one with the most code points stays, then
  the smallest doc_id (null last).  Of rows that agree in both, exactly one
  stays; which of them makes no difference, as their texts are equal in every
  respect but white space.
* A text whose digest another batch brought into the index is dropped; its
  ``keep_id`` is the one that the index holds.
* A batch without a name is one of its own, never a retry.  Other rows under a
  name that was used are decided anew as if the first ones were that batch's
  too: what these brought in stays in the index and is not known to them.
* An empty batch gives no rows and leaves the index as it is.
* Columns other than doc_id and text are not read and cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_key, keep_rows, materialise, read_table, KEY_HASH, KEY_ID

#: Deleted before comparison.
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_PATTERN, "")


class DigestIndex:
    """A table of digests, ``buckets`` files to a batch, in the warehouse.

    ``buckets`` is fixed for the life of the index; size it so that one bucket
    fits a task (50,000 at 100 TB).
    """

    COLUMNS = ["digest", "keep_id", "batch"]

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table = spark, table
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, rows: DataFrame) -> None:
        """Add digests: each bucket is written by one task, as one file."""
        (rows.select(*self.COLUMNS).repartition(self.buckets, "digest")
             .write.mode("append").format("parquet")
             .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def ingest(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Deduplicate one batch against itself and the index, append what is
        new, and return a decision for every row of the batch: the document
        key, doc_id, digest, keep_id, group_size (rows of this batch with the
        digest), known (brought into the index by another batch) and kept.
        Give ``batch`` the same name in a retry."""
        batch = batch or uuid.uuid4().hex
        rows = materialise(
            docs.select(*doc_key(),
                        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
                        F.length(F.coalesce(F.col("text"), F.lit(""))).alias("n_chars"),
                        F.monotonically_increasing_id().alias("row_no")),
            "digests")
        # max of a struct: most code points, then smallest doc_id with nulls last, then row
        rank = F.struct(F.col("n_chars"), F.col(KEY_ID).isNotNull().alias("has_id"),
                        F.negative(F.coalesce(KEY_ID, F.lit(0))).alias("neg_id"),
                        F.negative("row_no").alias("neg_row"))
        groups = (rows.groupBy("digest")
                      .agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
                      .select("digest", "group_size",
                              F.when(F.col("best.has_id"), F.negative("best.neg_id")).alias("batch_keep"),
                              F.negative("best.neg_row").alias("keep_row")))
        if not self.exists():
            self.append(groups.select("digest", F.col("batch_keep").alias("keep_id"), F.lit(batch).alias("batch")).limit(0))
        mine = F.col("batch") == batch
        index = self.read().filter(~mine)
        new = materialise(groups.hint("merge").join(index.select("digest"), "digest", "left_anti"), "new")
        known = (groups.hint("merge")
                 .join(index.select("digest", F.col("keep_id").alias("index_keep")), "digest", "inner"))
        decided = materialise(
            new.select("digest", "group_size", F.col("batch_keep").alias("keep_id"), "keep_row",
                       F.lit(False).alias("known"))
            .unionByName(known.select("digest", "group_size", F.col("index_keep").alias("keep_id"),
                                      F.lit(None).cast("long").alias("keep_row"), F.lit(True).alias("known"))),
            "decided")
        there = self.read().filter(mine).select("digest")
        self.append(new.hint("merge").join(there, "digest", "left_anti")
                       .select("digest", F.col("batch_keep").alias("keep_id"), F.lit(batch).alias("batch")))
        # both sides are plain shuffles, so AQE can split the rows of a hot digest
        return (rows.join(decided, "digest")
                    .select(KEY_ID, KEY_HASH, F.col(KEY_ID).alias("doc_id"), "digest", "keep_id", "group_size",
                            "known", F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(False)).alias("kept")))


def fresh_index(spark: SparkSession) -> DigestIndex:
    """An empty index of its own name, for one run."""
    return DigestIndex(spark, f"lf_digests_{uuid.uuid4().hex[:12]}")


def once(docs: DataFrame) -> DataFrame:
    """Decisions for one batch against an empty index that is dropped again
    (``ingest`` has written all that it reads from the index by then)."""
    index = fresh_index(docs.sparkSession)
    try:
        return index.ingest(docs)
    finally:
        index.drop()


def dedup(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged.  Of rows that are
    the same in doc_id and text, one stays."""
    decisions = index.ingest(docs, batch) if index else once(docs)
    kept = keep_rows(docs, decisions.filter("kept").dropDuplicates([KEY_ID, KEY_HASH]))
    keyed = kept.select(*doc_key(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_lf_row"))
    return keyed.dropDuplicates([KEY_ID, KEY_HASH]).select("_lf_row.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = once(read_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), w AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ASC NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id) AS kept, text_sha256 FROM w
"""
