"""Full and incremental loads.

The loads are short driver loops over *tables*, never over rows: each step
declares one DataFrame plan and writes it as a new snapshot version. Counts of
written rows come from ``Observation`` metrics of that same write; raw rows are
counted apart, without columns. Every table runs isolated: a failure becomes a
FAILED run-log row and the loop continues, as in the warehouse scripts, but
tables that depend on a failed one are skipped.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ntz_lit
from ..context import RunContext, work_root
from ..operators.key_bitmap import may_match
from ..operators.relational import high_water_mark, restrict_to_batch
from ..operators.upsert import upsert, upsert_partitions
from ..sources import versions as V
from ..sources.csv import read_raw
from ..sources.sinks import (RUN_LOG_SCHEMA, append_log, current_version, ensure_ops_tables, is_versioned,
                             read_current, read_previous, restore, was_live, write_snapshot)
from . import curate as C

# Table order of the loads (dimensions first, orders before
# their children because children find their parents by batch id).
FULL_ORDER = ["sellers", "products", "orders", "order_items", "order_payments", "order_reviews"]
DIMENSIONS = ["sellers", "products"]
FACTS = ["orders", "order_items", "order_payments", "order_reviews"]
RAW_NAMES = ["orders", "customers", "order_items", "order_payments", "order_reviews", "products",
             "category_translation", "sellers"]
DEFAULT_MARK = "2000-01-01 00:00:00"
# Independent tables are submitted from a few driver threads so their jobs
# share the cluster; each job is still fully distributed.
DEFAULT_PARALLEL = 4
#: Keys of a batch that a join may broadcast (some 8 MB in the driver).
BROADCAST_KEYS = 100_000


def _run_all(fn, items, parallel: int):
    """Map ``fn`` over ``items`` on a small thread pool, results in order."""
    if parallel <= 1 or len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=min(parallel, len(items))) as pool:
        return list(pool.map(fn, items))

# Upsert settings per fact table: keys, change column, columns updated.
MERGE_RULES = {
    "orders": (["order_id"], "order_status",
               ["order_status", "order_approved_at", "order_delivered_carrier_date",
                "order_delivered_customer_date", "days_to_delivery", "delivered_on_time"]),
    "order_items": (["order_id", "order_item_id"], "price",
                    ["price", "freight_value", "total_item_value"]),
    "order_payments": (["order_id", "payment_sequential"], "payment_value",
                       ["payment_value", "payment_type"]),
    "order_reviews": (["review_id"], "review_score",
                      ["review_score", "review_comment_message"]),
}


# Keys of the dimensions, which are replaced and not merged.
KEYS = {"sellers": ["seller_id"], "products": ["product_id"]}


@dataclass
class RawTables:
    """Raw inputs by name: orders, customers, order_items, order_payments,
    order_reviews, products, category_translation, sellers."""

    frames: dict[str, DataFrame]

    def __getitem__(self, k: str) -> DataFrame:
        return self.frames[k]


def curated_builders(raw: RawTables, ctx: RunContext) -> dict[str, tuple[DataFrame, Callable]]:
    """Per table: (raw frame whose rows are counted, builder of the curated
    frame from that observed raw frame)."""
    return {
        "sellers": (raw["sellers"], lambda r: C.curate_sellers(r, ctx)),
        "products": (raw["products"],
                     lambda r: C.curate_products(r, raw["category_translation"], ctx)),
        "orders": (raw["orders"], lambda r: C.curate_orders(r, raw["customers"], ctx)),
        "order_items": (raw["order_items"], lambda r: C.curate_order_items(r, ctx)),
        "order_payments": (raw["order_payments"], lambda r: C.curate_order_payments(r, ctx)),
        "order_reviews": (raw["order_reviews"], lambda r: C.curate_order_reviews(r, ctx)),
    }


def _log_row(ctx: RunContext, run_type: str, table: str, read: int, inserted: int,
             updated: int, skipped: int, status: str, duration: float, error: str | None = None,
             source_rows: int | None = None):
    return (ctx.batch_id, run_type, table, int(read), int(inserted), int(updated), int(skipped),
            status, error, ctx.run_ts, float(duration),
            None if source_rows is None else int(source_rows))


def _count_obs(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(f"{name}_{uuid.uuid4().hex}")
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs


class RunLog:
    """The run log of one load. Every row goes to the ops table when it
    happens (STARTED before a table is touched, SUCCESS, FAILED or SKIPPED
    after it), so a lost driver leaves behind how far it came. The frame that
    a load returns has the last row of each table."""

    def __init__(self, spark: SparkSession, ops_root: str | None, ctx: RunContext, run_type: str):
        self.spark, self.ctx, self.run_type = spark, ctx, run_type
        self.one_at_a_time = threading.Lock()      # two jobs must not commit into one folder at once
        self.path = f"{ops_root}/pipeline_run_log" if ops_root else None
        if ops_root:
            ensure_ops_tables(spark, ops_root)

    def _append(self, row: tuple) -> tuple:
        if self.path:
            with self.one_at_a_time:
                append_log(self.spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1), self.path, RUN_LOG_SCHEMA)
        return row

    def row(self, table: str, status: str, read: int = 0, inserted: int = 0, updated: int = 0, skipped: int = 0,
            seconds: float = 0.0, error: str | None = None, source_rows: int | None = None) -> tuple:
        return _log_row(self.ctx, self.run_type, table, read, inserted, updated, skipped, status, seconds, error,
                        source_rows)

    def run(self, table: str, step: Callable[[], dict]) -> tuple:
        """Run one table's step, which returns the counts of its row. An
        exception becomes a FAILED row with the whole error text."""
        t0 = time.time()
        self._append(self.row(table, "STARTED"))
        try:
            row = self.row(table, "SUCCESS", seconds=round(time.time() - t0, 2), **step())
        except Exception as exc:  # noqa: BLE001 - isolated per table
            row = self.row(table, "FAILED", seconds=round(time.time() - t0, 2), error=str(exc))
        return self._append(row[:10] + (round(time.time() - t0, 2),) + row[11:])

    def skip(self, table: str, why: str) -> tuple:
        return self._append(self.row(table, "SKIPPED", error=why))

    def frame(self, rows: list[tuple]) -> DataFrame:
        return self.spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def _laid_out(df: DataFrame, table: str, layout: dict) -> tuple[DataFrame, dict]:
    """Partition column and write options of a table's layout: (partition
    column, function frame -> Column[, clustering columns])."""
    if table not in layout:
        return df, {}
    col, fn, *cluster = layout[table]
    return df.withColumn(col, fn(df)), {"partition_by": [col], "sort_within": list(cluster[0]) if cluster else None}


def _write_table(df: DataFrame, path: str, ctx: RunContext, partition_by=None, sort_within=None) -> None:
    """A whole new version: with a manifest if the table has a partitioned layout."""
    if partition_by:
        V.replace(df, path, ctx.batch_id, partition_by, sort_within)
    else:
        write_snapshot(df, path, ctx.batch_id)


def _guard_schema(spark: SparkSession, raw_df: DataFrame, table: str, ctx: RunContext, log: RunLog, schemas: str | None) -> None:
    """X5 before a table is transformed: its raw schema against the last one
    recorded under ``schemas``. A breaking change raises, which ends the table as
    FAILED with nothing written; a new nullable column is a row of
    ``<schemas>_changes``."""
    if schemas:
        from .contracts import record_schema
        with log.one_at_a_time:                    # two jobs must not commit into one folder at once
            record_schema(spark, raw_df, table, ctx, schemas, changes_path=f"{schemas}_changes")


def _is_live(spark: SparkSession, curated_root: str, table: str, ctx: RunContext) -> bool:
    return current_version(spark, f"{curated_root}/{table}") == ctx.batch_id


def full_load(spark: SparkSession, raw: RawTables, curated_root: str, ctx: RunContext,
              ops_root: str | None = None, tables=FULL_ORDER,
              parallel: int = DEFAULT_PARALLEL, layout: dict | None = None, schemas: str | None = None,
              rejects: tuple[str, dict[str, Callable]] | None = None) -> DataFrame:
    """C7 + O1: build and write every curated table (they are independent,
    so up to ``parallel`` run at once); returns the run log in table order.

    A table whose live version is this batch's already is logged from what is
    there and not written again, so a load that lost its log can be run again.

    ``layout`` maps a table to ``(partition column, function frame ->
    Column[, clustering columns])``, e.g. ``{"orders": ("month",
    month_of_purchase, ["customer_id"])}``: that table is written partitioned
    and sorted, and later incremental loads merge into its touched partitions
    only. ``schemas`` is a folder in which raw schemas are recorded and against
    which they are checked. ``rejects`` is (rejects table, {table: function raw
    frame -> rules}): raw rows that break a rule go there and not into the curated
    table, in one pass over them (``dead_letters.split_write``)."""
    layout = layout or {}
    builders = curated_builders(raw, ctx)
    log = RunLog(spark, ops_root, ctx, "FULL")

    def load(table):
        raw_df, build = builders[table]
        _guard_schema(spark, raw_df, table, ctx, log, schemas)
        # counted apart from the build: an observed scan would take no pushed filters
        n_raw = raw_df.count()
        if _is_live(spark, curated_root, table, ctx):
            n_out = read_current(spark, f"{curated_root}/{table}").count()
        else:
            if rejects and table in rejects[1]:
                from .dead_letters import split_write
                raw_df, _ = split_write(raw_df, table, rejects[1][table](raw_df), ctx, rejects[0])
            out, kw = _laid_out(build(raw_df), table, layout)
            out, out_obs = _count_obs(out, f"cur_{table}")
            _write_table(out, f"{curated_root}/{table}", ctx, **kw)
            n_out = out_obs.get["n"]
        return {"read": n_raw, "inserted": n_out, "skipped": max(n_raw - n_out, 0), "source_rows": n_raw}

    return log.frame(_run_all(lambda t: log.run(t, lambda: load(t)), list(tables), parallel))


# --------------------------------------------------------------- incremental

def current_mark(spark: SparkSession, orders: DataFrame, default: str = DEFAULT_MARK):
    """High-water mark of the curated orders, fetched once as a literal so
    the delta filter can be pushed into the raw scan."""
    return high_water_mark(orders, "order_purchase_timestamp", default).first()[0]


def orders_delta(raw: RawTables, mark, ctx: RunContext, lookback_days: int = 0,
                 late_updates: bool = False, target: DataFrame | None = None) -> DataFrame:
    """U2 source.

    Default (as the warehouse load): rows purchased strictly after the mark.
    The filter is applied before the dedup (same winner, see
    ``curate.clean_orders``), then enrichment and metrics.

    ``lookback_days`` lowers the mark by that many days, so orders that
    arrive late with a timestamp at or just below the mark are not lost; the
    rows re-read that way match unchanged targets and are kept (the upsert is
    idempotent).

    ``late_updates`` also admits orders at or below the mark whose status
    differs from the target's (``target`` required). The changed keys come
    from the latest key, time and status of the raw rows alone, compared with
    the target's; only the raw rows of those keys and of new ones (a semi
    join) are then deduplicated in full.
    """
    m = ntz_lit(mark)
    if lookback_days:
        m = m - F.make_interval(days=F.lit(int(lookback_days)))
    if not late_updates:
        clean = C.clean_orders(raw["orders"], newer_than=m)
        return C.orders_from_clean(clean, raw["customers"])
    if target is None:
        raise ValueError("late_updates needs the current target")
    latest = C.clean_orders(raw["orders"]).select("order_id", "order_status", "order_purchase_timestamp")
    t = target.select("order_id", F.col("order_status").alias("_t_status")).distinct()
    changed = (latest.join(t, "order_id", "left")
               .filter((F.col("order_purchase_timestamp") > m) | (F.col("order_status") != F.col("_t_status")))
               .select("order_id"))
    clean = C.clean_orders(raw["orders"].join(changed, "order_id", "left_semi"))
    return C.orders_from_clean(clean, raw["customers"])


def child_delta(table: str, raw: RawTables, orders_now: DataFrame, ctx: RunContext) -> DataFrame:
    """U3-U5 source: raw child rows of the orders this batch touched, then
    the same typing and keep-one rule as the full load. Rows whose order is
    none of these for certain are left out before the join shuffles them. Whether
    the orders may be broadcast goes by their counted number: by their share of the
    compressed files, the keys of a large batch would be, once for each child table."""
    typed, dedup = {"order_items": (C.typed_items, C.dedup_items), "order_payments": (C.typed_payments, C.dedup_payments),
                    "order_reviews": (C.typed_reviews, C.dedup_reviews)}[table]
    touched = orders_now.filter(F.col("_batch_id") == ctx.batch_id).select("order_id")
    n = touched.count()
    near = may_match(typed(raw[table]), touched, ["order_id"], n)
    parents = orders_now if n <= BROADCAST_KEYS else orders_now.hint("merge")
    return dedup(restrict_to_batch(near, parents, "order_id", ctx.batch_id))


def merge_table(table: str, target: DataFrame, source: DataFrame, ctx: RunContext,
                **kw) -> DataFrame:
    keys, change, update_cols = MERGE_RULES[table]
    return upsert(target, source, keys, change, update_cols, ctx,
                  source_label=C.SOURCE_LABELS[table], **kw)


def incremental_load(spark: SparkSession, raw: RawTables, curated_root: str, ctx: RunContext,
                     ops_root: str | None = None, parallel: int = DEFAULT_PARALLEL,
                     layout: dict | None = None, tables=None, lookback_days: int = 0,
                     late_updates: bool = False, schemas: str | None = None, **merge_kw) -> DataFrame:
    """U9 + O2: mark -> dimension refresh -> orders -> items, payments,
    reviews; each written as a new snapshot version, or, for tables in
    ``layout``, merged into new files of their touched partitions, which one
    commit exchanges. ``lookback_days`` and
    ``late_updates`` go to ``orders_delta``, ``schemas`` is as in ``full_load``,
    ``merge_kw`` goes to the merges.

    Children find their parents by the batch id that the orders step stamps.
    If that step fails, they are logged SKIPPED and do not run. A table whose
    live version is this batch's already is done: it is logged SUCCESS from
    what is there, so a batch whose log was lost can be finished.
    Returns the run log (the last row of each table)."""
    layout = layout or {}
    builders = curated_builders(raw, ctx)
    log = RunLog(spark, ops_root, ctx, "INCREMENTAL")
    path_of = lambda table: f"{curated_root}/{table}"

    def stamped(table) -> dict:
        """Counts of a merge that is live already. Inserts and updates are
        told apart by the version before it."""
        now = read_current(spark, path_of(table))
        keys = MERGE_RULES[table][0]
        mine = now.filter(F.col("_batch_id") == ctx.batch_id)
        before = read_previous(spark, path_of(table))
        new = mine if before is None else mine.join(before.select(*keys), keys, "left_anti")
        n_mine, n_new = mine.count(), new.count()
        return {"read": now.count(), "inserted": n_new, "updated": n_mine - n_new}

    def dim(table):                                              # U8
        raw_df, build = builders[table]
        _guard_schema(spark, raw_df, table, ctx, log, schemas)
        n_raw = raw_df.count()
        if _is_live(spark, curated_root, table, ctx):
            n = read_current(spark, path_of(table)).count()
        else:
            out, kw = _laid_out(build(raw_df), table, layout)
            out, obs = _count_obs(out, f"dim_{table}")
            _write_table(out, path_of(table), ctx, **kw)
            n = obs.get["n"]
        return {"read": n, "inserted": n, "source_rows": n_raw}

    def delta(table, target):
        if table != "orders":
            return child_delta(table, raw, read_current(spark, path_of("orders")), ctx)
        mark = current_mark(spark, target)
        return orders_delta(raw, mark, ctx, lookback_days, late_updates, target)

    def fact(table):
        if _is_live(spark, curated_root, table, ctx):
            return stamped(table)
        _guard_schema(spark, raw[table], table, ctx, log, schemas)
        target = read_current(spark, path_of(table))
        # written once: the merge reads it twice, and a lost executor does not redo it
        work_root(spark)
        source = delta(table, target).checkpoint(eager=True)
        n_source = source.count()
        if table in layout:
            # partitioned table: new files for the touched partitions, one commit
            col, fn = layout[table][:2]
            keys, change, update_cols = MERGE_RULES[table]
            r = upsert_partitions(spark, path_of(table), source, keys, change, update_cols, ctx, col, fn,
                                  source_label=C.SOURCE_LABELS[table], **merge_kw)
            n_after = V.files(spark, path_of(table), r["commit"]).agg(F.sum("rows")).first()[0] or 0
            return {"read": n_after, "inserted": r["inserted"], "updated": r["updated"], "source_rows": n_source}
        merged = merge_table(table, target, source, ctx, source_rows=n_source, **merge_kw)
        obs = Observation(f"merge_{table}_{uuid.uuid4().hex}")
        a = F.col("_action")
        merged = merged.observe(obs, F.count(F.lit(1)).alias("after"),
                                F.count_if(a == "insert").alias("inserted"),
                                F.count_if(a == "update").alias("updated"))
        write_snapshot(merged.drop("_action"), path_of(table), ctx.batch_id)
        m = obs.get
        # records_read is the post-merge row count, skipped always 0
        return {"read": m["after"], "inserted": m["inserted"], "updated": m["updated"], "source_rows": n_source}

    # dimensions and orders are independent; children need the new orders
    todo = set(tables) if tables is not None else set(DIMENSIONS + FACTS)
    steps = [(t, lambda t=t: dim(t)) for t in DIMENSIONS if t in todo]
    if "orders" in todo:
        steps.append(("orders", lambda: fact("orders")))
    rows = _run_all(lambda s: log.run(*s), steps, parallel)
    children = [t for t in FACTS[1:] if t in todo]
    if any(r[2] == "orders" and r[7] != "SUCCESS" for r in rows):
        rows += [log.skip(t, "the orders step of this batch failed") for t in children]
    else:
        rows += _run_all(lambda t: log.run(t, lambda: fact(t)), children, parallel)
    return log.frame(rows)


def to_rerun(spark: SparkSession, log: DataFrame, ctx: RunContext) -> list[str]:
    """Tables that a resumed batch runs: those without a SUCCESS row, and if
    orders is among them, everything downstream of it too."""
    from .contracts import pending_tables
    pending = {r["table_name"] for r in pending_tables(spark, log, ctx.batch_id, DIMENSIONS + FACTS).collect()}
    if "orders" in pending:
        pending |= set(FACTS)
    return [t for t in DIMENSIONS + FACTS if t in pending]


def resume_incremental(spark: SparkSession, raw: RawTables, curated_root: str, ctx: RunContext,
                       log: DataFrame, ops_root: str | None = None, **kw) -> DataFrame:
    """Finish the batch ``ctx.batch_id``: the tables of ``to_rerun`` run again
    with the *same* batch id, by which children find the orders their batch
    touched. Tables whose version of this batch is live are not written
    again, whether or not the log knows of them."""
    pending = to_rerun(spark, log, ctx)
    if not pending:
        return spark.createDataFrame([], RUN_LOG_SCHEMA)
    return incremental_load(spark, raw, curated_root, ctx, ops_root=ops_root, tables=pending, **kw)


def undo_batch(spark: SparkSession, curated_root: str, batch_id: str, tables=None) -> DataFrame:
    """Take a batch back from all curated tables, children first: inserted
    rows go, updated ones get their earlier image. Afterwards the batch can be
    loaded again under the same id. Returns a row for each table: ``undone``, or
    ``untouched`` where the batch is not live (it never wrote the table, or was
    taken back already, so an interrupted undo can be run again).

    Where later batches are live, tables with manifests get the inverse of the
    batch's difference; a table of whole snapshots cannot, and raises."""
    todo, rows = [], []
    for table in reversed(list(tables or DIMENSIONS + FACTS)):
        path = f"{curated_root}/{table}"
        if is_versioned(spark, path):
            names = [c.version for c in V.history(spark, path)]
            wrote = names.count(batch_id) > names.count(f"undo {batch_id}")
            keys = MERGE_RULES[table][0] if table in MERGE_RULES else KEYS[table]
            step = lambda path=path, keys=keys: V.undo(spark, path, batch_id, keys)
        else:
            wrote = was_live(spark, path, batch_id)
            if wrote and current_version(spark, path) != batch_id:
                raise ValueError(f"{table}: later versions than {batch_id} are whole snapshots; take those back first")
            step = lambda path=path: restore(spark, path, batch_id)
        todo.append((table, step if wrote else None))
    for table, step in todo:
        if step:
            step()
        rows.append((table, "undone" if step else "untouched"))
    return spark.createDataFrame(rows, "table_name string, state string")


def raw_tables(spark: SparkSession, raw_root: str) -> RawTables:
    """The raw inputs as the CSV ingest wrote them: live good rows of
    ``<raw_root>/raw_<name>``, all text."""
    return RawTables({n: read_raw(spark, f"{raw_root}/raw_{n}") for n in RAW_NAMES})


def quality_run(spark: SparkSession, raw_orders: DataFrame, curated_root: str, ctx: RunContext,
                ops_root: str | None = None, catalog=None, gate: bool = False,
                strict: bool = False) -> DataFrame:
    """Q7-Q10 over the live curated tables: run the six checks (fused and
    concurrent), append the results to ``dq_results`` and, when ``gate``,
    raise if a CRITICAL check failed. Returns the result frame."""
    from ..operators import quality as Q
    orders = read_current(spark, f"{curated_root}/orders")
    items = read_current(spark, f"{curated_root}/order_items")
    payments = read_current(spark, f"{curated_root}/order_payments")
    kw = {"catalog": catalog} if catalog is not None else {}
    res = Q.run_checks(spark, Q.standard_checks(raw_orders, orders, items, payments, **kw), ctx)
    if ops_root:
        ensure_ops_tables(spark, ops_root)
        append_log(res, f"{ops_root}/dq_results", Q.DQ_SCHEMA)
    if gate:
        Q.gate(res, strict=strict)
    return res
