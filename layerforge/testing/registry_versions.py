"""Queries of versioned tables: merges by partition and by file, differences,
undo, concurrent writers, as-of reads, retention, clustering."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import functions as F

from .. import RunContext
from ..context import new_run_dir
from ..functions.clustering import clustered
from ..operators import key_counts as K
from ..operators import upsert as U
from ..plans import contracts as X
from ..plans import curate as C
from ..plans import dead_letters as D
from ..plans import loads as L
from ..plans import views as W
from ..sources import sinks as SK
from ..sources import versions as V
from . import oracle as O
from . import tables as TT
from .registry import (ALL_RAW, B1, B2, B2_LOAD, FULL_COUNTS, INC_MERGED_ORDERS, INC_SRC_ORDERS, INC_TGT_ORDERS, ORDER_OUT,
                       _MONTH_LAYOUT, _curated_facts, _fact_rows_sql, _inc_rows_sql, _month, _raw_tables, _sql, no_load_ts, register)

_KEYS, _CHANGE, _UPDATE = L.MERGE_RULES["orders"]
_LABEL = C.SOURCE_LABELS["orders"]
_MONTH_SQL = "strftime(order_purchase_timestamp, '%Y-%m') AS month"
B3 = RunContext(batch_id="b3")


def _orders_b1(spark, d):
    """The first load of orders as a versioned table by month."""
    root, raw = new_run_dir(spark, "orders-versions"), _raw_tables(spark, d, 1)
    first = X.with_month(C.curate_orders(raw["orders"], raw["customers"], B1), "order_purchase_timestamp")
    V.replace(first, root, "b1", ["month"], ["customer_id"], at=datetime(2024, 1, 1))
    return root


def _delta(spark, d, root):
    return L.orders_delta(_raw_tables(spark, d, 2), L.current_mark(spark, V.read(spark, root)), B2)


def _merge(spark, root, source, ctx, merge=U.upsert_files):
    return merge(spark, root, source, _KEYS, _CHANGE, _UPDATE, ctx, "month", _month, source_label=_LABEL)


@register("upsert_orders_by_file", _sql(f"SELECT * EXCLUDE (_action), {_MONTH_SQL} FROM ({INC_MERGED_ORDERS})", *ALL_RAW))
def q_upsert_by_file(spark, d):
    root = _orders_b1(spark, d)
    _merge(spark, root, _delta(spark, d, root), B2)
    return no_load_ts(V.read(spark, root))


@register("version_changes", _sql(
    f"SELECT * FROM (WITH m AS ({INC_MERGED_ORDERS}), t AS ({INC_TGT_ORDERS}) "
    "SELECT order_id, order_status, _batch_id, 'insert' AS change FROM m WHERE _action = 'insert' UNION ALL "
    "SELECT order_id, order_status, _batch_id, 'after' FROM m WHERE _action = 'update' UNION ALL "
    "SELECT t.order_id, t.order_status, t._batch_id, 'before' FROM t JOIN m USING (order_id) WHERE m._action = 'update')", *ALL_RAW))
def q_version_changes(spark, d):
    # what the second batch did, from the files that differ alone
    root = _orders_b1(spark, d)
    _merge(spark, root, _delta(spark, d, root), B2)
    old, new = V.history(spark, root)
    return V.changes(spark, root, old, new, ["order_id"]).select("order_id", "order_status", "_batch_id",
                                                                 F.col("_change").alias("change"))


def _loaded_and_undone(spark, d):
    """Both batches loaded (the second with updates of old orders), then the
    second taken back. Returns the lake's root."""
    root = new_run_dir(spark, "lake")
    L.full_load(spark, _raw_tables(spark, d, 1), f"{root}/curated", B1, layout=_MONTH_LAYOUT)
    L.incremental_load(spark, _raw_tables(spark, d, 2), f"{root}/curated", B2_LOAD, layout=_MONTH_LAYOUT, late_updates=True)
    L.undo_batch(spark, f"{root}/curated", "b2")
    return root


@register("undo_batch_orders", _sql(f"SELECT *, {_MONTH_SQL} FROM ({INC_TGT_ORDERS})", *ALL_RAW))
def q_undo_batch(spark, d):
    # older orders that the batch updated are back as they were, not gone
    return no_load_ts(SK.read_current(spark, f"{_loaded_and_undone(spark, d)}/curated/orders"))


@register("undo_batch_facts", _fact_rows_sql(f"SELECT *, {_MONTH_SQL} FROM {FULL_COUNTS['orders'][1]}",
                                             {t: FULL_COUNTS[t][1] for t in L.FACTS[1:]}))
def q_undo_batch_facts(spark, d):
    return _curated_facts(spark, _loaded_and_undone(spark, d))


@register("replay_after_undo", _inc_rows_sql(f", {_MONTH_SQL}"))
def q_replay_after_undo(spark, d):
    # restored, then loaded again under the same batch id: like a batch that ran once
    root = _loaded_and_undone(spark, d)
    L.incremental_load(spark, _raw_tables(spark, d, 2), f"{root}/curated", B2_LOAD, layout=_MONTH_LAYOUT)
    return _curated_facts(spark, root)


# a third batch marks every order of the first load that the second leaves alone as returned
_B3_SQL = (f"SELECT * EXCLUDE (_source_file, _batch_id) REPLACE ('returned' AS order_status) FROM ({INC_TGT_ORDERS}) "
           f"WHERE order_id NOT IN (SELECT order_id FROM ({INC_SRC_ORDERS}) WHERE order_id IS NOT NULL)")


def _third_batch(spark, root, second):
    first = V.read(spark, root, "b1")
    return (first.join(second.select("order_id"), "order_id", "left_anti").withColumn("order_status", F.lit("returned"))
                 .select(*[c for c in first.columns if not c.startswith("_") and c != "month"]))


@register("undo_below_later_batch", _sql("SELECT * EXCLUDE (_action), " + _MONTH_SQL + " FROM (" + O.merge_sql(
    INC_TGT_ORDERS, _B3_SQL, ["order_id"], "order_status", _UPDATE, ORDER_OUT, _LABEL, "b3") + ")", *ALL_RAW))
def q_undo_below(spark, d):
    # the second batch is taken back from under the third, which stays
    root = _orders_b1(spark, d)
    second = _delta(spark, d, root).checkpoint()
    _merge(spark, root, second, B2)
    _merge(spark, root, _third_batch(spark, root, second), B3, U.upsert_partitions)
    V.undo(spark, root, "b2", ["order_id"])
    return no_load_ts(V.read(spark, root))


@register("concurrent_merges", _sql("SELECT * EXCLUDE (_action), " + _MONTH_SQL + " FROM (" + O.merge_sql(
    f"SELECT * EXCLUDE (_action) FROM ({INC_MERGED_ORDERS})", _B3_SQL, ["order_id"], "order_status", _UPDATE, ORDER_OUT, _LABEL,
    "b3") + ")", *ALL_RAW))
def q_concurrent(spark, d):
    # two writers at once, of different orders in part of the same files: one
    # rebases if it can, or is told of the conflict and runs again; no row is lost
    root = _orders_b1(spark, d)
    second = _delta(spark, d, root).checkpoint()
    third = _third_batch(spark, root, second).checkpoint()

    def write(rows, ctx):
        for _ in range(4):
            try:
                return _merge(spark, root, rows, ctx)
            except V.Conflict:
                continue
        raise RuntimeError("no commit in four tries")

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, (second, third), (B2, B3)))
    return no_load_ts(V.read(spark, root))


@register("as_of_orders", _sql(
    "SELECT as_of, order_status, count(*) AS orders FROM ("
    f"SELECT '2024-01-15' AS as_of, order_status FROM ({INC_TGT_ORDERS}) UNION ALL "
    f"SELECT 'now' AS as_of, order_status FROM ({INC_MERGED_ORDERS})) GROUP BY as_of, order_status", *ALL_RAW))
def q_as_of(spark, d):
    root = _orders_b1(spark, d)
    _merge(spark, root, _delta(spark, d, root), B2)
    both = (V.read(spark, root, as_of=datetime(2024, 1, 15)).select(F.lit("2024-01-15").alias("as_of"), "order_status")
            .unionByName(V.read(spark, root).select(F.lit("now").alias("as_of"), "order_status")))
    return both.groupBy("as_of", "order_status").agg(F.count(F.lit(1)).alias("orders"))


@register("retention_rows", _sql(
    "SELECT CAST(0 AS BIGINT) AS last_seq, count(*) AS rows FROM raw_orders UNION ALL "
    "SELECT CAST(1 AS BIGINT), count(*) FROM raw_customers", "raw_orders", "raw_customers"))
def q_retention(spark, d):
    # four whole versions; in 2030 only the live one and the one before it must stay
    root = new_run_dir(spark, "retention")
    for n, rows in enumerate((TT.raw_orders(spark, d).select(F.col("order_id").alias("id")),
                              TT.raw_customers(spark, d).select(F.col("customer_id").alias("id")),
                              TT.raw_order_items(spark, d).select(F.col("order_id").alias("id")),
                              TT.raw_sellers(spark, d).select(F.col("seller_id").alias("id")))):
        V.replace(rows.select(F.col("id").cast("string").alias("id")), root, f"v{n}", at=datetime(2024, n + 1, 1))
    return V.removable(spark, root, datetime(2030, 1, 1)).groupBy("last_seq").agg(F.sum("rows").alias("rows"))


@register("items_clustered", O.with_raw(O.curated_items_sql(), "raw_order_items"))
def q_items_clustered(spark, d):
    # Z-order by seller and product: the same rows
    root = new_run_dir(spark, "items-clustered")
    V.replace(clustered(C.curate_order_items(TT.raw_order_items(spark, d), B1), ["seller_id", "product_id"], 16), root, "b1")
    return no_load_ts(V.read(spark, root))


@register("reviews_by_creation_month", _sql(
    f"SELECT strftime(review_creation_date, '%Y-%m') AS month, count(*) AS reviews, min(review_creation_date) AS first_day, "
    f"max(review_creation_date) AS last_day FROM ({O.curated_reviews_sql()}) GROUP BY 1", "raw_order_reviews"))
def q_reviews_by_month(spark, d):
    root = new_run_dir(spark, "reviews")
    reviews = X.with_month(C.curate_order_reviews(TT.raw_order_reviews(spark, d), B1), "review_creation_date")
    V.replace(reviews, root, "b1", ["month"], ["review_creation_date"])
    return V.read(spark, root).groupBy("month").agg(
        F.count(F.lit(1)).alias("reviews"), F.min("review_creation_date").alias("first_day"), F.max("review_creation_date").alias("last_day"))


def _counted_sql(step: str, orders: str) -> str:
    return (f"SELECT '{step}' AS step, 'customer once' AS check_name, CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS affected_count, "
            f"CAST(coalesce(sum(n), 0) AS BIGINT) AS total_count FROM (SELECT customer_id, count(*) AS n FROM ({orders}) GROUP BY 1) UNION ALL "
            f"SELECT '{step}', 'order of item', count(*) FILTER (NOT EXISTS (SELECT 1 FROM ({orders}) o WHERE o.order_id = i.order_id)), "
            f"count(*) FROM ({O.curated_items_sql()}) i")


@register("counted_checks_after_each_batch", _sql(" UNION ALL ".join(_counted_sql(s, o) for s, o in (
    ("first", INC_TGT_ORDERS), ("second", f"SELECT * EXCLUDE (_action) FROM ({INC_MERGED_ORDERS})"), ("undone", INC_TGT_ORDERS))), *ALL_RAW))
def q_counted_checks(spark, d):
    # uniqueness and orphans after a load, a merge and its undo, from counts that only the differences update
    orders, items = _orders_b1(spark, d), new_run_dir(spark, "items-versions")
    V.replace(C.curate_order_items(TT.raw_order_items(spark, d), B1), items, "b1")
    counts = {n: new_run_dir(spark, f"counts-{n}") for n in ("customer", "order", "item")}
    delta, out = _delta(spark, d, orders).checkpoint(), None
    for step, act in (("first", lambda: None), ("second", lambda: _merge(spark, orders, delta, B2)),
                      ("undone", lambda: V.undo(spark, orders, "b2", ["order_id"]))):
        act()
        K.refresh(spark, orders, counts["customer"], ["customer_id"])
        K.refresh(spark, orders, counts["order"], ["order_id"])
        K.refresh(spark, items, counts["item"], ["order_id"])
        both = (K.check_unique(spark, counts["customer"], ["customer_id"]).withColumn("check_name", F.lit("customer once"))
                .unionByName(K.check_foreign_key(spark, counts["item"], counts["order"], "order_id")
                             .withColumn("check_name", F.lit("order of item"))))
        # one step's rows at a time: the driver does not hold the plans and stages of all six checks at once
        both = both.select(F.lit(step).alias("step"), "check_name", "affected_count", "total_count").checkpoint(eager=True)
        out = both if out is None else out.unionByName(both)
    return out


@register("read_versions_as_one", _sql(
    "SELECT order_id, order_item_id, CAST(price AS DOUBLE) AS price, note, v AS version FROM ("
    "SELECT order_id, order_item_id, CAST(price AS INTEGER) AS price, CAST(NULL AS VARCHAR) AS note, 'b1' AS v FROM raw_order_items UNION ALL "
    "SELECT order_id, order_item_id, CAST(price AS INTEGER), NULL, 'b2' FROM raw_order_items UNION ALL "
    "SELECT order_id, order_item_id, price, 'with a note', 'b2' FROM raw_order_items WHERE price IS NOT NULL)", "raw_order_items"))
def q_read_versions(spark, d):
    # whole prices first; then rows with cents and a new column are appended, and no file is rewritten
    root, items = new_run_dir(spark, "items-evolving"), TT.raw_order_items(spark, d)
    whole = items.select("order_id", "order_item_id", F.bround("price").cast("int").alias("price"))
    V.replace(whole, root, "b1")
    V.append(items.filter("price IS NOT NULL").select("order_id", "order_item_id", F.col("price").cast("double").alias("price"),
                                                      F.lit("with a note").alias("note")), root, "b2", evolve=True)
    both = V.read_versions(spark, root, ["b1", "b2"])
    return both.select("order_id", "order_item_id", "price", "note", F.col("_version").alias("version"))


@register("schema_guard", O.with_raw(
    f"SELECT 'table' AS kind, 'sellers' AS name, 'SUCCESS' AS state, 'b2' AS detail, count(*) AS rows FROM ({O.curated_sellers_sql()}) UNION ALL "
    f"SELECT 'table', 'products', 'FAILED', 'b1', count(*) FROM ({O.curated_products_sql()}) UNION ALL "
    "SELECT 'change', 'sellers.rating', 'WARNING', 'added', count(*) FROM raw_sellers UNION ALL "
    "SELECT 'change', 'products.product_weight_g', 'BREAKING', 'dropped', count(*) FROM raw_products",
    "raw_sellers", "raw_products", "raw_category_translation"))
def q_schema_guard(spark, d):
    # the second batch brings a new column for sellers and lacks one of products
    root, raw = new_run_dir(spark, "lake"), _raw_tables(spark, d, 2)
    schemas, tables = f"{root}/ops/schema_versions", ["sellers", "products"]
    L.full_load(spark, raw, f"{root}/curated", B1, tables=tables, schemas=schemas)
    frames = dict(raw.frames, sellers=raw["sellers"].withColumn("rating", F.lit(None).cast("double")),
                  products=raw["products"].drop("product_weight_g"))
    log = L.incremental_load(spark, L.RawTables(frames), f"{root}/curated", B2_LOAD, tables=tables, schemas=schemas)
    out = spark.read.parquet(f"{schemas}_changes").select(
        F.lit("change").alias("kind"), F.concat_ws(".", "table_name", "column_name").alias("name"), F.col("severity").alias("state"),
        F.col("change").alias("detail"), F.when(F.col("table_name") == "sellers", raw["sellers"].count())
        .otherwise(raw["products"].count()).cast("bigint").alias("rows"))
    for t in tables:
        now = SK.read_current(spark, f"{root}/curated/{t}").agg(F.count(F.lit(1)).alias("rows"))
        state = log.filter(F.col("table_name") == t).first()["status"]
        out = out.unionByName(now.select(F.lit("table").alias("kind"), F.lit(t).alias("name"), F.lit(state).alias("state"),
                                         F.lit(SK.current_version(spark, f"{root}/curated/{t}")).alias("detail"), "rows"))
    return out


@register("rejects_replayed_once", _sql(
    "SELECT order_id, order_item_id, coalesce(price, 1.5) AS price, CASE WHEN price IS NULL THEN 'b2' ELSE 'b1' END AS entered "
    "FROM raw_order_items WHERE freight_value <> 0 OR freight_value IS NULL UNION ALL "
    "SELECT order_id, order_item_id, price, 'open' FROM raw_order_items WHERE freight_value = 0", "raw_order_items"))
def q_rejects_replayed(spark, d):
    # rejected in one pass of the first batch, corrected in the second, which is lost once and run again;
    # a third finds nothing to take, and what cannot be corrected stays open
    rejects, ledger = new_run_dir(spark, "rejects"), new_run_dir(spark, "ledger")
    raw = TT.raw_order_items(spark, d).select("order_id", "order_item_id", "price", "freight_value")
    rules = {"price_missing": F.col("price").isNull(), "freight_zero": F.col("freight_value") == 0}
    good, _ = D.split_write(raw, "order_items", rules, B1, rejects)
    fix = lambda rows: rows.withColumn("price", F.coalesce("price", F.lit(1.5).cast(raw.schema["price"].dataType)))
    take = lambda ctx: D.claim(spark, rejects, ledger, "order_items", raw.schema, fix, rules, ctx)
    take(B2)
    out = good.withColumn("entered", F.lit("b1")).unionByName(take(B2).withColumn("entered", F.lit("b2")))
    out = out.unionByName(take(B3).withColumn("entered", F.lit("b3")))
    left = D.open_rejects(spark, rejects, ledger, "order_items").select(F.from_json("row", raw.schema).alias("r")).select("r.*")
    return out.unionByName(left.withColumn("entered", F.lit("open"))).select("order_id", "order_item_id", "price", "entered")


@register("load_with_rejects", _sql(
    "SELECT 'order_items' AS name, count(*) AS rows FROM ("
    + O.curated_items_sql(src="(SELECT * FROM raw_order_items WHERE price IS NOT NULL)") + ") UNION ALL "
    "SELECT 'rejects', count(*) FROM raw_order_items WHERE price IS NULL", "raw_order_items"))
def q_load_with_rejects(spark, d):
    root = new_run_dir(spark, "lake")
    L.full_load(spark, _raw_tables(spark, d, 1), f"{root}/curated", B1, tables=["order_items"],
                rejects=(f"{root}/rejects", {"order_items": lambda r: {"price_missing": F.col("price").isNull()}}))
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
    return n(SK.read_current(spark, f"{root}/curated/order_items"), "order_items").unionByName(n(V.read(spark, f"{root}/rejects"), "rejects"))


_LOGGED = {"orders": "order_id", "customers": "customer_id", "order_items": "order_id", "order_payments": "order_id", "sellers": "seller_id"}


@register("compacted_log", _sql(" UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS rows, count(DISTINCT {k}) AS ids FROM raw_{t}" for t, k in _LOGGED.items()), *ALL_RAW))
def q_compacted_log(spark, d):
    # one append a table, a compaction after all but the last, and the same rows in fewer files
    root, raw = new_run_dir(spark, "log"), _raw_tables(spark, d, 2)
    frames = dict(raw.frames, orders=TT.raw_orders(spark, d), order_items=TT.raw_order_items(spark, d),
                  order_payments=TT.raw_order_payments(spark, d))
    for n, (t, k) in enumerate(_LOGGED.items()):
        rows = frames[t].select(F.lit(t).alias("name"), F.col(k).cast("string").alias("id"))
        if n == len(_LOGGED) - 1:
            V.compact(spark, root)
        V.append(rows, root, t) if n else V.replace(rows, root, t)
    return V.read(spark, root).groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))


def _seen_sql(reader: str, clear: str, hidden: str, key: str) -> str:
    return (f"SELECT '{reader}' AS reader, seller_id, seller_state, CASE WHEN {clear} THEN seller_city "
            f"ELSE sha256('{key}:' || seller_city) END AS seller_city FROM raw_sellers WHERE {clear} OR {hidden}")


@register("secured_view", _sql(_seen_sql("ana", "seller_state < 'j'", "seller_state < 'r'", "k1") + " UNION ALL "
                               + _seen_sql("ben", "seller_state >= 'r'", "seller_state < 'j'", "k2"), "raw_sellers"))
def q_secured_view(spark, d):
    # two readers see some states clear and some masked, through one view
    sellers = TT.raw_sellers(spark, d).select("seller_id", "seller_state", "seller_city")
    sellers.createOrReplaceTempView("lf_sellers")
    state = F.col("seller_state")
    rights = [(s.select(F.lit(reader), "seller_state", F.lit(clear), F.lit(key)))
              for reader, key, clear, s in (("ana", "k1", True, sellers.filter(state < "j")), ("ana", "k1", False, sellers.filter(state < "r")),
                                            ("ben", "k2", True, sellers.filter(state >= "r")), ("ben", "k2", False, sellers.filter(state < "j")))]
    both = rights[0].union(rights[1]).union(rights[2]).union(rights[3]).distinct().toDF("reader", "tenant", "clear", "mask_key")
    both.createOrReplaceTempView("lf_entitlements")
    spark.sql("DECLARE OR REPLACE VARIABLE lf_reader STRING")
    W.create_view(spark, "lf_sellers_seen", "lf_sellers", "lf_entitlements", "seller_state", {"seller_city": "hash"}, "lf_reader", temporary=True)
    out = None
    for reader in ("ana", "ben"):
        spark.sql(f"SET VARIABLE lf_reader = '{reader}'")
        path = new_run_dir(spark, "seen")
        spark.table("lf_sellers_seen").select("seller_id", "seller_state", "seller_city").write.parquet(path)
        one = spark.read.parquet(path).select(F.lit(reader).alias("reader"), "seller_id", "seller_state", "seller_city")
        out = one if out is None else out.unionByName(one)
    return out
