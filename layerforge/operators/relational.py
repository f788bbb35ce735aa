"""Relational operators: keep-one dedup, enrichment joins, anti/semi joins,
key-set differences and the aggregates the loads and checks are built on.

Design notes for scale
----------------------
* ``keep_one`` is ``row_number() = 1`` over a key window. Catalyst turns it
  into a *partial* ``WindowGroupLimit`` before the shuffle and a final one
  after it, so each map task forwards at most one row per key: a key that
  holds a third of all rows costs one row per input partition in the
  exchange, not a third of the table.
* Joins are written as plain equi-joins and left to AQE, which broadcasts a
  side only when its *measured* shuffle size is under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps a
  sort-merge join whose skewed partitions it splits. Nothing is forced to
  broadcast on a size that is not known.
* Anti joins are written as ``left_anti`` (Catalyst does not rewrite
  ``LEFT JOIN ... IS NULL``), semi joins as ``left_semi``; both shuffle only
  the key columns of the second side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _order_expr(o) -> Column:
    """Accepts a Column (used as is), a column name (descending, NULLs last,
    the warehouse default for ``DESC``) or a (name, "asc"|"desc") pair."""
    if isinstance(o, Column):
        return o
    if isinstance(o, str):
        return F.col(o).desc_nulls_last()
    name, direction = o
    return (F.col(name).asc_nulls_first() if direction == "asc"
            else F.col(name).desc_nulls_last())


def keep_one(df: DataFrame, keys: str | Sequence[str], order_by: Sequence = (),
             tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key, the first by ``order_by``.

    ``tie_breakers`` (ascending, NULLs first) make the winner reproducible;
    by default every other column is used, so rows that survive are the
    same whatever the input order or partitioning. NULL keys form one group,
    as in SQL ``PARTITION BY``.
    """
    keys = _cols(keys)
    order = [_order_expr(o) for o in order_by]
    if tie_breakers is None:
        used = set(keys) | {o for o in order_by if isinstance(o, str)} | {
            o[0] for o in order_by if isinstance(o, tuple)}
        tie_breakers = [c for c in df.columns if c not in used]
    order += [F.col(c).asc_nulls_first() for c in tie_breakers]
    if not order:
        order = [F.col(keys[0])]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def enrich(df: DataFrame, lookup: DataFrame, on, how: str = "left",
           lookup_unique: str = "allow", lookup_keys: Sequence[str] | None = None) -> DataFrame:
    """Left outer enrichment join.

    ``on`` is a list of shared column names (USING) or a join condition.
    ``lookup_unique``: ``allow`` keeps warehouse behaviour (a duplicated
    lookup key multiplies fact rows), ``first`` keeps one lookup row per key,
    ``error`` fails the job when a lookup key repeats.
    """
    keys = list(lookup_keys) if lookup_keys else (_cols(on) if not isinstance(on, Column) else None)
    if lookup_unique != "allow":
        if keys is None:
            raise ValueError("lookup_keys is required with a join condition")
        if lookup_unique == "first":
            lookup = keep_one(lookup, keys)
        elif lookup_unique == "error":
            # counted by key with partial sums, checked when the join runs
            row = F.struct(*[F.col(f"`{c}`") for c in lookup.columns])
            lookup = (lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(row).alias("_row"))
                      .withColumn("_ok", F.assert_true(F.col("_n") == 1, F.lit("duplicate lookup key")))
                      .filter(F.col("_ok").isNull()).select("_row.*"))
        else:
            raise ValueError(f"unknown lookup_unique={lookup_unique!r}")
    return df.join(lookup, on, how)


def restrict_to_batch(df: DataFrame, parent: DataFrame, key: str | Sequence[str],
                      batch_id: str, batch_col: str = "_batch_id") -> DataFrame:
    """Rows whose parent was written by ``batch_id``; a semi join, so a
    parent never multiplies child rows and only parent keys are shuffled."""
    keys = _cols(key)
    touched = parent.filter(F.col(batch_col) == F.lit(batch_id)).select(*keys)
    return df.join(touched, keys, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Child rows without a parent (NULL keys count as orphans)."""
    keys = _cols(key)
    return child.join(parent.select(*keys), keys, "left_anti")


def keys_missing_in(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Distinct keys of ``a`` absent from ``b`` (one direction only)."""
    keys = _cols(key)
    return a.select(*keys).distinct().join(b.select(*keys), keys, "left_anti")


def domain_df(spark, values, name: str = "value") -> DataFrame:
    """A literal list expanded to rows (one ``explode`` of an array
    literal), e.g. a catalog to join or anti-join against."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


# ---------------------------------------------------------------- aggregates

def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """A1: one-row frame with the row count."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_violations(df: DataFrame, predicate: Column,
                     affected: str = "affected_count", total: str = "total_count") -> DataFrame:
    """A2: violations and total in one pass (NULL predicate = not counted)."""
    return df.agg(F.count_if(F.coalesce(predicate, F.lit(False))).cast("bigint").alias(affected),
                  F.count(F.lit(1)).alias(total))


def high_water_mark(df: DataFrame, ts_col: str, default: str = "2000-01-01 00:00:00",
                    alias: str = "high_water_mark") -> DataFrame:
    """The maximum of ``ts_col``; an empty table yields ``default``
    (the MAX of an empty table is NULL, which is coalesced)."""
    dtype = df.schema[ts_col].dataType
    return df.agg(F.coalesce(F.max(ts_col), F.lit(default).cast(dtype)).alias(alias))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str], cnt: str = "cnt") -> DataFrame:
    """A4: keys seen more than once with their count (NULL keys group)."""
    keys = _cols(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(cnt))
              .filter(F.col(cnt) > 1))


def excess_duplicates(df: DataFrame, keys: str | Sequence[str],
                      alias: str = "excess_duplicates") -> DataFrame:
    """A5: number of rows beyond the first per key, 0 when none."""
    d = duplicate_keys(df, keys)
    return d.agg(F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("bigint").alias(alias))


def distinct_key_count(df: DataFrame, key: str, alias: str = "distinct_keys") -> DataFrame:
    """COUNT(DISTINCT key) (NULL not counted)."""
    return df.agg(F.count_distinct(F.col(key)).alias(alias))


def distinct_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """SELECT DISTINCT keys."""
    return df.select(*_cols(keys)).distinct()


def sample_ids(df: DataFrame, id_col: str, n: int = 5, alias: str = "sample_ids") -> DataFrame:
    """T2 + P19: JSON array text of up to ``n`` ids, NULL ids kept as
    ``null``, ``[]`` when there are none.

    The ``orderBy(...).limit(n)`` plans as a distributed top-n
    (``TakeOrderedAndProject``): every task keeps ``n`` rows, so only
    ``n * partitions`` rows ever reach the final merge, however many rows
    violate. Wrapping each id in a struct keeps NULL ids, which
    ``collect_list`` would drop.
    """
    top = df.select(F.col(id_col).alias("_id")).orderBy(F.col("_id").asc_nulls_first()).limit(n)
    return top.agg(
        F.to_json(F.transform(F.sort_array(F.collect_list(F.struct(F.col("_id")))),
                              lambda e: e["_id"])).alias(alias))
