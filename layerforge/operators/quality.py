"""Data-quality checks (Q1-Q10).

A check yields one row ``(affected_count, total_count, sample_ids)``. Every
check frame is lazy and built from aggregates only: counts are partial
aggregates (map-side) merged into one row, and the sample is a distributed
top-5 (``TakeOrderedAndProject``). The per-check pieces are stacked with
``unionByName`` and folded with ``max`` into the single result row, so no
violating row set is ever gathered whole and no cross join is needed.

``run_checks`` is the runner: row-predicate checks over the same frame are
fused into one scan (one ``agg`` with a ``count_if`` per predicate) and
sampled only if they fail; checks that compare keys count and sample from one
shuffle. A check that raises is recorded with status ERROR, affected -1, as
the warehouse runner does.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from ..functions.columns import before, not_in_domain
from .relational import sample_ids

# The order-status catalog of the domain check.
ORDER_STATUS_CATALOG = ["delivered", "shipped", "canceled", "invoiced",
                        "processing", "approved", "unavailable", "created"]

DQ_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("check_description", T.StringType(), True),
    T.StructField("table_name", T.StringType(), True),
    T.StructField("severity", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("affected_count", T.LongType(), True),
    T.StructField("total_count", T.LongType(), True),
    T.StructField("sample_ids", T.StringType(), True),
    T.StructField("check_timestamp", T.TimestampNTZType(), False),
])


def _fold(*parts: DataFrame) -> DataFrame:
    """Stack one-row partial results (missing columns NULL) and keep the
    non-NULL value of each column: one result row."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    return u.agg(F.max("affected_count").cast("bigint").alias("affected_count"),
                 F.max("total_count").cast("bigint").alias("total_count"),
                 F.coalesce(F.max("sample_ids"), F.lit("[]")).alias("sample_ids"))


def _count(df: DataFrame, alias: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def row_check_frame(df: DataFrame, predicate: Column, id_col: str, n: int = 5) -> DataFrame:
    """A2 + T2: violations of a row predicate (NULL = not a violation)."""
    p = F.coalesce(predicate, F.lit(False))
    counts = df.agg(F.count_if(p).cast("bigint").alias("affected_count"),
                    F.count(F.lit(1)).alias("total_count"))
    return _fold(counts, sample_ids(df.filter(p), id_col, n))


def check_not_null(df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """Q1: rows with a NULL in any mandatory column."""
    return row_check_frame(df, null_predicate(cols), id_col)


def null_predicate(cols: Sequence[str]) -> Column:
    p = None
    for c in cols:
        p = F.col(c).isNull() if p is None else p | F.col(c).isNull()
    return p


def check_domain(df: DataFrame, col: str, values: Sequence[str], id_col: str) -> DataFrame:
    """Q2: values outside the catalog; a NULL value is not counted."""
    return row_check_frame(df, not_in_domain(col, values), id_col)


def check_order(df: DataFrame, earlier: str, later: str, id_col: str) -> DataFrame:
    """Q5: ``later`` present and before ``earlier``."""
    return row_check_frame(df, before(later, earlier), id_col)


def check_foreign_key(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Q3: child rows whose key has no parent; total = child rows.

    Child rows are counted per key *before* the shuffle (partial aggregate
    on the map side), so the anti join moves one row per key and task; a key
    holding a third of the child rows costs one row per input partition.
    The sample lists the orphan rows' keys in key order (a key repeats once
    per row), drawn from the top five keys only.
    """
    return foreign_key_of_counts(child.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")), parent, key)


def foreign_key_of_counts(per_key: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Q3 from the child's row count by key (``key``, ``cnt``)."""
    orph = per_key.join(parent.select(key), key, "left_anti")
    first_keys = orph.orderBy(F.col(key).asc_nulls_first()).limit(5)
    rows = first_keys.select(F.explode(F.array_repeat(F.col(key), F.least(F.col("cnt"), F.lit(5))
                                                      .cast("int"))).alias(key))
    # the total is the sum of the same per-key counts: one scan of the child
    # and one shuffle (reused) serve count, total and sample
    return _fold(orph.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("affected_count")),
                 per_key.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_count")),
                 sample_ids(rows, key))


def check_unique(df: DataFrame, keys: str | Sequence[str], id_col: str | None = None) -> DataFrame:
    """Q4: duplicate keys; affected = rows beyond the first per key (NULL
    keys form one group); total = all rows. One partial aggregate per key
    feeds the excess, the total and the sample (one scan, one shuffle)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return unique_of_counts(df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")), keys, id_col)


def unique_of_counts(g: DataFrame, keys: Sequence[str], id_col: str | None = None) -> DataFrame:
    """Q4 from the row count by key (the keys, ``cnt``)."""
    excess = g.agg(F.coalesce(F.sum(F.when(F.col("cnt") > 1, F.col("cnt") - 1)), F.lit(0))
                   .alias("affected_count"))
    total = g.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_count"))
    return _fold(excess, total, sample_ids(g.filter(F.col("cnt") > 1), id_col or keys[0]))


def check_keys_present(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Q6: distinct keys of ``a`` missing in ``b`` (one direction);
    total = COUNT(DISTINCT key) of ``a``."""
    # one distinct of the keys (a reused shuffle) serves total, count and sample
    distinct = a.select(key).distinct()
    m = distinct.join(b.select(key), key, "left_anti")
    total = distinct.agg(F.count(F.col(key)).alias("total_count"))
    return _fold(_count(m, "affected_count"), total, sample_ids(m, key))


# ------------------------------------------------------------------ runner

@dataclass
class Check:
    """A named check. Either a row predicate over ``df`` (fusable with other
    predicates over the same frame) or a prebuilt one-row ``frame``."""

    name: str
    description: str
    table: str
    severity: str
    df: DataFrame | None = None
    predicate: Column | None = None
    id_col: str | None = None
    frame: DataFrame | None = None
    meta: dict = field(default_factory=dict)

    def result_frame(self) -> DataFrame:
        if self.frame is not None:
            return self.frame
        return row_check_frame(self.df, self.predicate, self.id_col)


def _status(affected: int) -> str:
    return "PASS" if affected == 0 else "FAIL"


def _row(ctx: RunContext, c: Check, status: str, affected: int, total: int, sample: str):
    return (ctx.batch_id, c.name, c.description, c.table, c.severity, status,
            int(affected), int(total), sample, ctx.run_ts)


def _eval_one(c: Check, ctx: RunContext) -> tuple:
    try:
        r = c.result_frame().collect()
        row = r[0] if r else None
        affected = int(row["affected_count"]) if row and row["affected_count"] else 0
        total = int(row["total_count"]) if row and row["total_count"] else 0
        sample = row["sample_ids"] if row else "[]"
        return _row(ctx, c, _status(affected), affected, total, sample)
    except Exception as exc:  # noqa: BLE001 - a failing check is a result
        c.meta["error"] = str(exc)
        return _row(ctx, c, "ERROR", -1, 0, "[]")


def _eval_fused(grp: list[Check], ctx: RunContext) -> list[tuple]:
    """All row predicates over one frame in one scan (a ``count_if`` each);
    samples only for the failed ones. Falls back to one check at a time if
    the fused scan fails, so an erroring predicate stays isolated."""
    df = grp[0].df
    try:
        aggs = [F.count(F.lit(1)).alias("_total")] + [
            F.count_if(F.coalesce(c.predicate, F.lit(False))).alias(f"_a{i}")
            for i, c in enumerate(grp)]
        row = df.agg(*aggs).collect()[0]
    except Exception:  # noqa: BLE001
        return [_eval_one(c, ctx) for c in grp]
    total = row["_total"] or 0
    out = []
    for i, c in enumerate(grp):
        affected = row[f"_a{i}"] or 0
        sample = "[]"
        if affected:
            sample = sample_ids(df.filter(F.coalesce(c.predicate, F.lit(False))),
                                c.id_col).collect()[0][0]
        out.append(_row(ctx, c, _status(affected), affected, total, sample))
    return out


def evaluate_checks(checks: Sequence[Check], ctx: RunContext, fuse: bool = True,
                    parallel: int = 4) -> list[tuple]:
    """Run the checks; returns result tuples in ``DQ_SCHEMA`` order. Only the
    one-row result of each check reaches the driver. Row-predicate checks on
    the same frame are fused into one scan; the fused groups and the other
    checks are submitted from up to ``parallel`` driver threads (concurrent
    jobs)."""
    units: list[list[Check]] = []
    if fuse:
        groups: dict[int, list[Check]] = {}
        for c in checks:
            if c.frame is None and c.df is not None:
                groups.setdefault(id(c.df), []).append(c)
        fused = {c.name for g in groups.values() if len(g) > 1 for c in g}
        units += [g for g in groups.values() if len(g) > 1]
        units += [[c] for c in checks if c.name not in fused]
    else:
        units = [[c] for c in checks]

    def run(unit: list[Check]) -> list[tuple]:
        # a row predicate is counted first and sampled only if it failed
        return _eval_fused(unit, ctx) if unit[0].frame is None else [_eval_one(unit[0], ctx)]

    if parallel > 1 and len(units) > 1:
        with ThreadPoolExecutor(max_workers=min(parallel, len(units))) as pool:
            done = list(pool.map(run, units))
    else:
        done = [run(u) for u in units]
    results = {r[1]: r for rows in done for r in rows}
    return [results[c.name] for c in checks]


def run_checks(spark: SparkSession, checks: Sequence[Check], ctx: RunContext,
               fuse: bool = True, parallel: int = 4) -> DataFrame:
    """Q7: results of all checks as a ``DQ_SCHEMA`` frame (one row each)."""
    return spark.createDataFrame(evaluate_checks(checks, ctx, fuse, parallel), DQ_SCHEMA)


def with_pct(results: DataFrame) -> DataFrame:
    """Q8: violation percentage as text with two decimals, ``n/a`` when the
    total is 0."""
    pct = F.format_string("%.2f%%", F.col("affected_count") / F.col("total_count") * 100)
    return results.withColumn(
        "violation_pct", F.when(F.col("total_count") != 0, pct).otherwise(F.lit("n/a")))


def summarize_checks(results: DataFrame) -> DataFrame:
    """Q9: number of PASS / FAIL / ERROR results and the total."""
    s = F.col("status")
    return results.agg(F.count_if(s == "PASS").cast("bigint").alias("passed"),
                       F.count_if(s == "FAIL").cast("bigint").alias("failed"),
                       F.count_if(s == "ERROR").cast("bigint").alias("errored"),
                       F.count(F.lit(1)).alias("total"))


def critical_failures(results: DataFrame, strict: bool = False) -> DataFrame:
    """Q10 (frame): CRITICAL checks that failed (and errored when strict)."""
    bad = ["FAIL", "ERROR"] if strict else ["FAIL"]
    return results.filter((F.col("severity") == "CRITICAL") & F.col("status").isin(bad))


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame, strict: bool = False) -> None:
    """Q10: raise when a CRITICAL check failed; the names come back, not the
    data (at most one row per check)."""
    names = [r["check_name"] for r in critical_failures(results, strict)
             .select("check_name").collect()]
    if names:
        raise QualityGateError("critical checks failed: " + ", ".join(sorted(names)))


# -------------------------------------------- the six checks of the runs

# Name -> (description, table, severity) of the result rows.
STANDARD_META = {
    "null_mandatory_fields_orders": ("Orders with NULL order_id, customer_id, or order_status", "raw_orders", "CRITICAL"),
    "invalid_order_status": ("Orders with order_status not in approved catalog values", "orders", "WARNING"),
    "orphan_order_items": ("order_items rows whose order_id has no matching order in curated orders", "order_items",
                           "ERROR"),
    "duplicate_order_ids_raw": ("order_id values that appear more than once in raw_orders", "raw_orders", "ERROR"),
    "invalid_date_range_delivery": ("Orders where delivered_customer_date < purchase_timestamp", "orders", "WARNING"),
    "payments_without_items": ("Orders that have payment records but no item records in curated",
                               "order_payments / order_items", "WARNING"),
}

def standard_checks(raw_orders: DataFrame, orders: DataFrame, items: DataFrame,
                    payments: DataFrame, catalog: Sequence[str] = ORDER_STATUS_CATALOG
                    ) -> list[Check]:
    """The six checks run after each load, over the given frames."""
    how = {
        "null_mandatory_fields_orders": dict(df=raw_orders, id_col="order_id", predicate=null_predicate(
            ["order_id", "customer_id", "order_status"])),
        "invalid_order_status": dict(df=orders, id_col="order_id", predicate=not_in_domain("order_status", catalog)),
        "orphan_order_items": dict(frame=check_foreign_key(items, orders, "order_id")),
        "duplicate_order_ids_raw": dict(frame=check_unique(raw_orders, "order_id")),
        "invalid_date_range_delivery": dict(df=orders, id_col="order_id", predicate=before(
            "order_delivered_customer_date", "order_purchase_timestamp")),
        "payments_without_items": dict(frame=check_keys_present(payments, items, "order_id")),
    }
    return [Check(name, *STANDARD_META[name], **kw) for name, kw in how.items()]
