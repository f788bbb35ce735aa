"""Rows that can have no partner are told from the others before a join shuffles them.

A merge or a batch's semi join concerns few keys of a large table, but a plain join
shuffles the whole of it. The hashes of the smaller side's keys are set as bits of a
bitmap, about eight bits a key, which is kept as rows of ``BITS`` bits and is
broadcast; at ``MAX_ROWS`` rows it is bounded at some 20 MB whatever the size of the
tables. A row whose bit is not set has no partner for certain; one whose bit is set
may have one, which the join that follows decides. Where the smaller side is too
large for that, or the types of the keys differ, all rows may have one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 16
BITS = WORDS * 64
BITS_PER_KEY = 8
MAX_ROWS = 131_072
#: Types whose equal values have equal hashes.
_HASHED = {"string", "bigint", "int", "smallint", "tinyint", "date", "timestamp", "timestamp_ntz", "boolean"}


def _place(keys: Sequence[str], n: int):
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n * BITS).cast("bigint"))


def _parts():
    """Row of the bitmap, word of the row and bit of the word of a place."""
    at = F.col("_bm_at")
    return (F.shiftright(at, BITS.bit_length() - 1), F.shiftright(at, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int"),
            at.bitwiseAND(F.lit(63)).cast("int"))


def _usable(df: DataFrame, other: DataFrame, keys: Sequence[str], rows: int) -> bool:
    a, b = dict(df.dtypes), dict(other.dtypes)
    return rows <= MAX_ROWS * BITS and all(a[k] == b[k] and a[k] in _HASHED for k in keys)


def _flagged(df: DataFrame, other: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    n = max(1, min(MAX_ROWS, -(-rows * BITS_PER_KEY // BITS)))
    row, word, bit = _parts()
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bm_bit"))
    bitmap = (other.select(*[F.col(f"`{k}`") for k in keys]).dropna().select(_place(keys, n).alias("_bm_at"))
                   .select(row.alias("_bm_row"), word.alias("_bm_word"), bit.alias("_bm_bit")).groupBy("_bm_row")
                   .agg(F.array(*[F.coalesce(F.bit_or(F.when(F.col("_bm_word") == i, one)), F.lit(0).cast("bigint"))
                                  for i in range(WORDS)]).alias("_bm_words")))
    return (df.withColumn("_bm_at", _place(keys, n)).withColumn("_bm_row", row).join(F.broadcast(bitmap), "_bm_row", "left")
              .withColumn("_bm_may", F.coalesce(F.getbit(F.col("_bm_words")[word], bit) == 1, F.lit(False))))


def may_match(df: DataFrame, other: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The rows of ``df`` that may equal a row of ``other`` in ``keys``: all that do,
    and about one in eight of the others. ``rows`` is the number of ``other``'s rows."""
    if not _usable(df, other, keys, rows):
        return df
    return _flagged(df, other, keys, rows).filter("_bm_may").select(*[F.col(f"`{c}`") for c in df.columns])


def split(df: DataFrame, other: DataFrame, keys: Sequence[str], rows: int) -> tuple[DataFrame, DataFrame | None]:
    """``may_match`` and the rest of ``df``, if there can be one."""
    if not _usable(df, other, keys, rows):
        return df, None
    flagged, cols = _flagged(df, other, keys, rows), [F.col(f"`{c}`") for c in df.columns]
    return flagged.filter("_bm_may").select(*cols), flagged.filter("NOT _bm_may").select(*cols)
