"""Helpers shared by the training-data operators.

Row keys. A document is addressed by ``(doc_id, xxhash64(text))``: doc_ids may
be null or repeated, so the id alone does not name a row.  Rows that agree in
both carry the same text and so get the same decision.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import new_run_dir

#: ASCII white space; a word is a run of anything else.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Key columns that operators use internally.  Input columns are never carried
#: along under their own names next to these, so clashes cannot occur.
KEY_ID, KEY_HASH = "_lf_id", "_lf_hash"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """The two key columns of a document row."""
    return [F.col(id_col).cast("long").alias(KEY_ID),
            F.xxhash64(F.col(text_col)).alias(KEY_HASH)]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet in the shared work folder and read it back.

    This cuts the lineage: a lost executor costs a re-read of the table, not
    the work that made it.
    """
    spark = df.sparkSession
    path = f"{new_run_dir(spark, label)}/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_equal(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on the document key that also matches null ids.

    Null ids are folded to a value outside the key's hash (0, with a flag), so
    the condition stays an equi-join.
    """
    return (
        F.coalesce(a[KEY_ID], F.lit(0)).eqNullSafe(F.coalesce(b[KEY_ID], F.lit(0)))
        & a[KEY_ID].isNull().eqNullSafe(b[KEY_ID].isNull())
        & a[KEY_HASH].eqNullSafe(b[KEY_HASH])
    )


def keep_rows(docs: DataFrame, kept_keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document key is in ``kept_keys``, with the
    columns of ``docs`` unchanged."""
    left = docs.select(*doc_key(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_lf_row"))
    right = kept_keys.select(KEY_ID, KEY_HASH)
    return left.join(right, key_equal(left, right), "left_semi").select("_lf_row.*")


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch],
              schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one record batch."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null counts as empty."""
    return [x if x is not None else "" for x in column.to_pylist()]


def chunks_of(batches, max_bytes: int, size_of=lambda b: b.nbytes):
    """Cut and group record batches into chunks of about ``max_bytes`` (at
    least one row); bounds what one numpy pass holds, whatever the sizes of
    partitions and batches."""
    held, total = [], 0
    for b in (part for batch in batches for part in _cut(batch, max_bytes, size_of)):
        held.append(b)
        total += size_of(b)
        if total >= max_bytes:
            yield held
            held, total = [], 0
    if held:
        yield held


def _cut(batch, max_bytes: int, size_of):
    """A batch in slices of at most ``max_bytes``, or of one row."""
    if batch.num_rows <= 1 or size_of(batch) <= max_bytes:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from _cut(batch.slice(0, half), max_bytes, size_of)
    yield from _cut(batch.slice(half), max_bytes, size_of)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (multiply and xor-shift), on uint64."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker.  Functions of this
    package reach workers by value, so module globals would not outlast a task."""
    name = "_lf_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return vars(sys.modules[name]).setdefault("cache", {})
