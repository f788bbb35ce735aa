"""Clustering on several columns at once (X1): rows in Z-order, cut into files.

A sort by (seller, product) lets a reader skip files by seller only. Here each
column is cut into ``2**bits`` bins of about equal row counts, and the bits of the
bin numbers are interleaved into one key. Files are ranges of that key, so each
covers a narrow range of *every* column, and the minimum and maximum that parquet
keeps for each column prune on any of them alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows sampled for the bounds of the bins (for any size of table: the bins'
#: counts then differ by a few percent, which moves no row to a wrong result).
SAMPLE_ROWS = 20_000


def bin_bounds(df: DataFrame, cols: Sequence[str], bits: int, seed: int = 7) -> list[list]:
    """Upper bounds of all bins but the last, for each column: quantiles of a
    random sample of fixed size (a distributed top-n by a random number). NULL is
    below all. Equal bounds are one."""
    rows = df.select(*cols).orderBy(F.rand(seed)).limit(SAMPLE_ROWS).collect()
    out = []
    for i in range(len(cols)):
        values = sorted(r[i] for r in rows if r[i] is not None)
        cuts = {values[len(values) * k // 2 ** bits] for k in range(1, 2 ** bits)} if values else set()
        out.append(sorted(cuts))
    return out


def bin_number(col: Column, bounds: list) -> Column:
    """How many bounds are below or equal to the value, by a tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col < F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return F.when(col.isNull(), F.lit(0)).otherwise(tree(0, len(bounds)))


def interleave(numbers: Sequence[Column], bits: int) -> Column:
    """One key of the numbers' bits, the highest bits of all columns first."""
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i, n in enumerate(numbers):
            one = F.shiftright(n.cast("long"), bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(numbers) + len(numbers) - 1 - i))
    return key


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int = 6) -> Column:
    bounds = bin_bounds(df, cols, bits)
    return interleave([bin_number(F.col(c), b) for c, b in zip(cols, bounds)], bits)


def clustered(df: DataFrame, cols: Sequence[str], files: int, bits: int = 6) -> DataFrame:
    """Rows range-partitioned into ``files`` parts by their Z-order key, and
    sorted by it; written as they are, each part is one file. The columns break
    ties, so a pair of values that holds a third of all rows is cut too."""
    key = "_zorder"
    keyed = df.withColumn(key, zorder_key(df, cols, bits))
    rest = [c for c in df.columns if c not in cols]
    return (keyed.repartitionByRange(files, key, *cols, *rest).sortWithinPartitions(key, *cols).drop(key))
