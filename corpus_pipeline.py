"""Corpus pipeline: quality rules, exact dedup, SimHash near-dedup, substring
dedup and packing over ``documents``.

Each stage works on all that the one before it kept.  The first three return
the rows that stay, the fourth the same rows with duplicate spans cut out of
their texts, the last the places of all segments in padded batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm import exact_dedup, packing, quality_rules, simhash, substring_dedup
from layerforge.llm.common import KEY_ID, materialise, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).select(F.col(KEY_ID).alias("doc_id"), "segment", "start", "n_tokens",
                                     "bucket_tokens", "batch", "slot")


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("substring dedup", substrings),
    ("packing", pack),
]

#: The robust outlier estimates and the fingerprint links cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
