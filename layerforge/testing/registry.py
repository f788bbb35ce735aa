"""Registered queries (Spark) and their DuckDB oracles, keyed by name.

Each query takes ``(spark, sf_dir)``, builds the raw adaptations from the
supplied tables and runs one operator or load of the library over them.
``_load_timestamp`` (wall-clock) is left out of compared results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import RunContext
from ..plans import curate as C
from . import oracle as O
from . import tables as TT

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

B1 = RunContext(batch_id=TT.BATCH_1)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def no_load_ts(df: DataFrame) -> DataFrame:
    return df.drop("_load_timestamp")


# ------------------------------------------------------------ curated tables

@register("curate_orders", O.with_raw(O.curated_orders_sql(), "raw_orders", "raw_customers"))
def q_curate_orders(spark, d):
    return no_load_ts(C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d), B1))


@register("curate_order_items", O.with_raw(O.curated_items_sql(), "raw_order_items"))
def q_curate_order_items(spark, d):
    return no_load_ts(C.curate_order_items(TT.raw_order_items(spark, d), B1))


@register("curate_order_payments", O.with_raw(O.curated_payments_sql(), "raw_order_payments"))
def q_curate_order_payments(spark, d):
    return no_load_ts(C.curate_order_payments(TT.raw_order_payments(spark, d), B1))


@register("curate_order_reviews", O.with_raw(O.curated_reviews_sql(), "raw_order_reviews"))
def q_curate_order_reviews(spark, d):
    return no_load_ts(C.curate_order_reviews(TT.raw_order_reviews(spark, d), B1))


@register("curate_products", O.with_raw(O.curated_products_sql(), "raw_products",
                                        "raw_category_translation"))
def q_curate_products(spark, d):
    return no_load_ts(C.curate_products(TT.raw_products(spark, d),
                                        TT.raw_category_translation(spark, d), B1))


@register("curate_sellers", O.with_raw(O.curated_sellers_sql(), "raw_sellers"))
def q_curate_sellers(spark, d):
    return no_load_ts(C.curate_sellers(TT.raw_sellers(spark, d), B1))


# ======================================================== shared test inputs

from pyspark.sql import functions as F  # noqa: E402

from ..functions import columns as P  # noqa: E402
from ..operators import quality as Q  # noqa: E402
from ..operators import relational as R  # noqa: E402
from ..operators import upsert as U  # noqa: E402
from ..plans import loads as L  # noqa: E402
from ..plans import ops as OPS  # noqa: E402

B2 = RunContext(batch_id=TT.BATCH_2)
ORDER_OUT = C.ORDER_COLS + ["_source_file", "_batch_id"]


def target_orders(spark, d):
    """First load: curated orders purchased up to the cutoff, batch b1."""
    cur = C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d), B1)
    return cur.filter(F.col("order_purchase_timestamp") <= TT.cutoff())


def _orders_merge(spark, d):
    """(first-load target, merged orders). The target stands for a written
    table: it is materialised once (reliable checkpoint) so the mark, the
    merge and the children's targets all read it instead of recomputing it."""
    from ..context import work_root
    work_root(spark)
    tgt = target_orders(spark, d).checkpoint(eager=True)
    mark = L.current_mark(spark, tgt)
    src = L.orders_delta(L.RawTables({"orders": TT.raw_orders_batch2(spark, d),
                                      "customers": TT.raw_customers(spark, d)}), mark, B2)
    return tgt, L.merge_table("orders", tgt, src.checkpoint(eager=True), B2)


def merged_orders(spark, d):
    return _orders_merge(spark, d)[1]


def _child_target(spark, d, table, first_orders):
    raw = {"order_items": TT.raw_order_items(spark, d),
           "order_payments": TT.raw_order_payments(spark, d),
           "order_reviews": TT.raw_order_reviews(spark, d)}[table]
    build = {"order_items": C.curate_order_items, "order_payments": C.curate_order_payments,
             "order_reviews": C.curate_order_reviews}[table]
    return build(raw, B1).join(first_orders.select("order_id"), "order_id", "left_semi")


def merged_child(spark, d, table):
    raw = L.RawTables({"order_items": TT.raw_order_items(spark, d, reprice=True),
                       "order_payments": TT.raw_order_payments(spark, d, reprice=True),
                       "order_reviews": TT.raw_order_reviews(spark, d)})
    tgt, merged = _orders_merge(spark, d)
    # what the load reads as written tables is materialised here too
    orders_now = merged.drop("_action").checkpoint(eager=True)
    src = L.child_delta(table, raw, orders_now, B2).checkpoint(eager=True)
    return L.merge_table(table, _child_target(spark, d, table, tgt).checkpoint(eager=True), src, B2)


# SQL pieces for the same inputs
TGT_ORDERS = O.target_orders_sql()
MARK = f"(SELECT coalesce(max(order_purchase_timestamp), TIMESTAMP '2000-01-01') FROM ({TGT_ORDERS}))"
SRC_ORDERS = (f"SELECT * EXCLUDE (_source_file, _batch_id) FROM ({O.curated_orders_sql('b2', 'raw_orders_b2')}) "
              f"WHERE order_purchase_timestamp > {MARK}")
MERGED_ORDERS = O.merge_sql(TGT_ORDERS, SRC_ORDERS, ["order_id"], "order_status",
                            L.MERGE_RULES["orders"][2], ORDER_OUT, C.SOURCE_LABELS["orders"], "b2")
ORD_RAW = ("raw_orders", "raw_customers", "raw_orders_b2")


def _child_sql(table):
    cur = {"order_items": O.curated_items_sql, "order_payments": O.curated_payments_sql,
           "order_reviews": O.curated_reviews_sql}[table]
    cols = {"order_items": C.ITEM_COLS, "order_payments": C.PAYMENT_COLS,
            "order_reviews": C.REVIEW_COLS}[table] + ["_source_file", "_batch_id"]
    tgt = f"SELECT * FROM ({cur('b1')}) WHERE order_id IN (SELECT order_id FROM ({TGT_ORDERS}))"
    b2src = {"order_items": "raw_order_items_b2", "order_payments": "raw_order_payments_b2",
             "order_reviews": "raw_order_reviews"}[table]
    touched = f"(SELECT order_id FROM ({MERGED_ORDERS}) WHERE _batch_id = 'b2')"
    restricted = f"(SELECT * FROM {b2src} WHERE order_id IN {touched})"
    src = f"SELECT * EXCLUDE (_source_file, _batch_id) FROM ({cur('b2', restricted)})"
    keys, change, upd = L.MERGE_RULES[table]
    return O.merge_sql(tgt, src, keys, change, upd, cols, C.SOURCE_LABELS[table], "b2")


CHILD_RAW = {"order_items": ("raw_order_items", "raw_order_items_b2"),
             "order_payments": ("raw_order_payments", "raw_order_payments_b2"),
             "order_reviews": ("raw_order_reviews",)}


def _sql(body, *raw):
    return O.with_raw(body, *raw)


# ================================================= P: column functions

@register("norm_lower", _sql(f"SELECT order_id, lower({O.trim_ws('order_status')}) AS status_norm "
                             "FROM raw_orders", "raw_orders"))
def q_norm_lower(spark, d):
    return TT.raw_orders(spark, d).select("order_id", P.norm_lower("order_status").alias("status_norm"))


@register("norm_upper", _sql(f"SELECT customer_id, upper({O.trim_ws('customer_state')}) AS state_norm "
                             "FROM raw_customers", "raw_customers"))
def q_norm_upper(spark, d):
    return TT.raw_customers(spark, d).select("customer_id",
                                             P.norm_upper("customer_state").alias("state_norm"))


@register("blank_to_null", _sql(f"SELECT review_id, order_id, nullif({O.trim_ws('review_comment_title')}, '') "
                                "AS title FROM raw_order_reviews", "raw_order_reviews"))
def q_blank_to_null(spark, d):
    return TT.raw_order_reviews(spark, d).select(
        "review_id", "order_id", P.blank_to_null("review_comment_title").alias("title"))


@register("cast_cols", _sql("SELECT CAST(order_id AS VARCHAR) AS order_id, "
                            "CAST(order_item_id AS BIGINT) AS order_item_id, "
                            "CAST(price AS DOUBLE) AS price, "
                            "CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date "
                            "FROM raw_order_items", "raw_order_items"))
def q_cast_cols(spark, d):
    # raw CSV columns arrive as text: cast everything to string first, then
    # apply the strict typed casts of the curate step
    raw = TT.raw_order_items(spark, d)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return text.select("order_id",
                       P.cast_strict("order_item_id", "int64").alias("order_item_id"),
                       P.cast_strict("price", "float64").alias("price"),
                       P.cast_strict("shipping_limit_date", "timestamp").alias("shipping_limit_date"))


@register("cast_or_zero", _sql("SELECT order_id, coalesce(CAST(payment_installments AS BIGINT), 0) "
                               "AS installments, coalesce(CAST(payment_sequential AS BIGINT), 0) AS seq, "
                               "coalesce(CAST(payment_value AS DOUBLE), 0.0) AS value "
                               "FROM raw_order_payments", "raw_order_payments"))
def q_cast_or_zero(spark, d):
    return TT.raw_order_payments(spark, d).select(
        "order_id", P.cast_or_zero("payment_installments", "int64").alias("installments"),
        P.cast_or_zero("payment_sequential", "int64").alias("seq"),
        P.cast_or_zero("payment_value", "float64").alias("value"))


@register("days_between_dates", _sql(
    "SELECT order_id, CASE WHEN order_delivered_customer_date IS NOT NULL THEN "
    "CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE), "
    "CAST(order_delivered_customer_date AS DATE)) AS BIGINT) END AS days FROM raw_orders", "raw_orders"))
def q_days_between(spark, d):
    return TT.raw_orders(spark, d).select(
        "order_id", P.days_between_dates("order_delivered_customer_date",
                                         "order_purchase_timestamp").alias("days"))


@register("on_time_flag", _sql(
    "SELECT order_id, CASE WHEN order_delivered_customer_date IS NOT NULL AND "
    "order_estimated_delivery_date IS NOT NULL THEN order_delivered_customer_date <= "
    "order_estimated_delivery_date END AS on_time FROM raw_orders", "raw_orders"))
def q_on_time(spark, d):
    return TT.raw_orders(spark, d).select(
        "order_id", P.on_time("order_delivered_customer_date",
                              "order_estimated_delivery_date").alias("on_time"))


@register("add_lineage", _sql("SELECT *, 'raw.raw_sellers' AS _source_file, 'b1' AS _batch_id "
                              "FROM raw_sellers", "raw_sellers"))
def q_add_lineage(spark, d):
    return no_load_ts(C.add_lineage(TT.raw_sellers(spark, d), "raw.raw_sellers", B1))


@register("review_range_filter", _sql(O.typed_reviews_sql(), "raw_order_reviews"))
def q_review_range(spark, d):
    return C.typed_reviews(TT.raw_order_reviews(spark, d))


@register("domain_violations", _sql(
    f"SELECT order_id, order_status FROM ({O.curated_orders_sql()}) "
    "WHERE order_status NOT IN ('p', 'f')", "raw_orders", "raw_customers"))
def q_domain_violations(spark, d):
    cur = C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d))
    return cur.filter(P.not_in_domain("order_status", TT.STATUS_CATALOG_TEST)) \
              .select("order_id", "order_status")


@register("domain_rows", _sql(
    f"SELECT status, CAST(count(o.order_id) AS BIGINT) AS orders FROM "
    "(SELECT unnest(['p', 'f']) AS status) c LEFT JOIN "
    f"({O.curated_orders_sql()}) o ON o.order_status = c.status GROUP BY status",
    "raw_orders", "raw_customers"))
def q_domain_rows(spark, d):
    # catalog expanded to rows (explode of an array literal), then every
    # catalog value with its number of curated orders
    cat = R.domain_df(spark, TT.STATUS_CATALOG_TEST, "status")
    cur = C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d))
    per = cur.groupBy(F.col("order_status").alias("status")).agg(F.count(F.lit(1)).alias("orders"))
    return cat.join(per, "status", "left").select(
        "status", F.coalesce(F.col("orders"), F.lit(0)).cast("bigint").alias("orders"))


@register("json_sample", _sql(
    "SELECT coalesce(CAST(to_json(list(order_id ORDER BY order_id NULLS FIRST)) AS VARCHAR), '[]') "
    "AS sample_ids FROM (SELECT order_id FROM raw_orders_gaps WHERE order_status IS NULL "
    "ORDER BY order_id NULLS FIRST LIMIT 5)", "raw_orders_gaps"))
def q_json_sample(spark, d):
    g = TT.raw_orders_with_gaps(spark, d)
    return R.sample_ids(g.filter(F.col("order_status").isNull()), "order_id")


@register("changed_rows", _sql(
    f"SELECT t.order_id, t.order_status AS old_status, s.order_status AS new_status "
    f"FROM ({TGT_ORDERS}) t JOIN ({SRC_ORDERS}) s ON t.order_id = s.order_id "
    "WHERE t.order_status <> s.order_status", *ORD_RAW))
def q_changed_rows(spark, d):
    tgt = target_orders(spark, d).alias("t")
    mark = L.current_mark(spark, tgt)
    src = L.orders_delta(L.RawTables({"orders": TT.raw_orders_batch2(spark, d),
                                      "customers": TT.raw_customers(spark, d)}), mark, B2).alias("s")
    j = tgt.join(src, F.col("t.order_id") == F.col("s.order_id"))
    return j.filter(P.changed(F.col("t.order_status"), F.col("s.order_status"))).select(
        F.col("t.order_id").alias("order_id"), F.col("t.order_status").alias("old_status"),
        F.col("s.order_status").alias("new_status"))


@register("date_order_violations", _sql(
    f"SELECT order_id FROM ({O.curated_orders_sql()}) WHERE order_delivered_customer_date IS NOT NULL "
    "AND order_delivered_customer_date < order_purchase_timestamp", "raw_orders", "raw_customers"))
def q_date_order(spark, d):
    cur = C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d))
    return cur.filter(P.before("order_delivered_customer_date", "order_purchase_timestamp")) \
              .select("order_id")


# ======================================================== J: joins

@register("enrich_left", _sql(
    f"SELECT o.order_id, o.customer_id, c.customer_city FROM ({O.clean_orders_sql()}) o "
    f"LEFT JOIN ({O.CUSTOMERS_CLEAN}) c USING (customer_id)", "raw_orders", "raw_customers"))
def q_enrich_left(spark, d):
    j = R.enrich(C.clean_orders(TT.raw_orders(spark, d)), C.clean_customers(TT.raw_customers(spark, d)),
                 ["customer_id"])
    return j.select("order_id", "customer_id", "customer_city")


@register("enrich_normalised_key", _sql(
    f"SELECT product_id, product_category_name_en FROM ({O.curated_products_sql()})",
    "raw_products", "raw_category_translation"))
def q_enrich_norm(spark, d):
    return C.curate_products(TT.raw_products(spark, d), TT.raw_category_translation(spark, d)) \
            .select("product_id", "product_category_name_en")


@register("restrict_to_batch", _sql(
    f"SELECT * FROM raw_order_items_b2 WHERE order_id IN "
    f"(SELECT order_id FROM ({MERGED_ORDERS}) WHERE _batch_id = 'b2')",
    *ORD_RAW, "raw_order_items", "raw_order_items_b2"))
def q_restrict(spark, d):
    return R.restrict_to_batch(TT.raw_order_items(spark, d, reprice=True),
                               merged_orders(spark, d), "order_id", TT.BATCH_2)


@register("orphans", _sql(
    f"SELECT i.order_id, i.order_item_id FROM ({O.curated_items_sql()}) i "
    f"LEFT JOIN ({TGT_ORDERS}) o USING (order_id) WHERE o.order_id IS NULL",
    "raw_order_items", "raw_orders", "raw_customers"))
def q_orphans(spark, d):
    items = C.curate_order_items(TT.raw_order_items(spark, d))
    return R.orphans(items, target_orders(spark, d), "order_id").select("order_id", "order_item_id")


@register("keys_missing_in", _sql(
    f"SELECT DISTINCT o.order_id FROM ({O.curated_orders_sql()}) o WHERE o.order_id NOT IN "
    f"(SELECT order_id FROM ({O.curated_items_sql()}))",
    "raw_orders", "raw_customers", "raw_order_items"))
def q_keys_missing(spark, d):
    orders = C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d))
    items = C.curate_order_items(TT.raw_order_items(spark, d))
    return R.keys_missing_in(orders, items, "order_id")


# ===================================================== A: aggregations

_RAW_NAMES = ["raw_orders", "raw_customers", "raw_order_items", "raw_order_payments",
              "raw_order_reviews", "raw_products", "raw_category_translation", "raw_sellers"]


def _raw_frames(spark, d):
    return {"raw_orders": TT.raw_orders(spark, d), "raw_customers": TT.raw_customers(spark, d),
            "raw_order_items": TT.raw_order_items(spark, d),
            "raw_order_payments": TT.raw_order_payments(spark, d),
            "raw_order_reviews": TT.raw_order_reviews(spark, d),
            "raw_products": TT.raw_products(spark, d),
            "raw_category_translation": TT.raw_category_translation(spark, d),
            "raw_sellers": TT.raw_sellers(spark, d)}


@register("table_counts", _sql(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _RAW_NAMES), *_RAW_NAMES))
def q_table_counts(spark, d):
    parts = [R.row_count(df).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in _raw_frames(spark, d).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("count_violations", _sql(
    "SELECT CAST(count_if(order_id IS NULL OR customer_id IS NULL OR order_status IS NULL) AS BIGINT) AS affected_count, "
    "count(*) AS total_count FROM raw_orders_gaps", "raw_orders_gaps"))
def q_count_violations(spark, d):
    return R.count_violations(TT.raw_orders_with_gaps(spark, d),
                              Q.null_predicate(["order_id", "customer_id", "order_status"]))


@register("high_water_mark", _sql(f"SELECT {MARK} AS high_water_mark", "raw_orders", "raw_customers"))
def q_hwm(spark, d):
    return R.high_water_mark(target_orders(spark, d), "order_purchase_timestamp")


@register("duplicate_keys", _sql("SELECT order_id, count(*) AS cnt FROM raw_orders GROUP BY order_id "
                                 "HAVING count(*) > 1", "raw_orders"))
def q_duplicate_keys(spark, d):
    return R.duplicate_keys(TT.raw_orders(spark, d), "order_id")


@register("excess_duplicates", _sql(
    "SELECT CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) AS excess_duplicates FROM "
    "(SELECT count(*) AS cnt FROM raw_order_items GROUP BY order_id, order_item_id HAVING count(*) > 1)",
    "raw_order_items"))
def q_excess(spark, d):
    return R.excess_duplicates(TT.raw_order_items(spark, d), ["order_id", "order_item_id"])


@register("distinct_key_count", _sql("SELECT count(DISTINCT order_id) AS distinct_keys "
                                     "FROM raw_order_payments", "raw_order_payments"))
def q_distinct_count(spark, d):
    return R.distinct_key_count(TT.raw_order_payments(spark, d), "order_id")


@register("distinct_keys", _sql("SELECT DISTINCT order_id FROM raw_order_payments", "raw_order_payments"))
def q_distinct_keys(spark, d):
    return R.distinct_keys(TT.raw_order_payments(spark, d), "order_id")


@register("violations_with_total", _sql(
    f"SELECT count(*) AS affected_count, (SELECT count(*) FROM ({O.curated_items_sql()})) AS total_count "
    f"FROM ({O.curated_items_sql()}) i LEFT JOIN ({TGT_ORDERS}) o USING (order_id) "
    "WHERE o.order_id IS NULL", "raw_order_items", "raw_orders", "raw_customers"))
def q_viol_total(spark, d):
    return Q.check_foreign_key(C.curate_order_items(TT.raw_order_items(spark, d)),
                               target_orders(spark, d), "order_id") \
            .select("affected_count", "total_count")


# ========================================================= W: windows

_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
       "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_EV = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("keep_one_highest", f"""SELECT * FROM lineitem QUALIFY ROW_NUMBER() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC NULLS LAST,
    {', '.join(f'{c} ASC NULLS FIRST' for c in _LI if c not in ('l_orderkey', 'l_linenumber', 'l_extendedprice'))}) = 1""")
def q_keep_one_highest(spark, d):
    return R.keep_one(TT.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_extendedprice"])


@register("keep_one_latest", f"""SELECT * FROM events QUALIFY ROW_NUMBER() OVER (
    PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
    {', '.join(f'{c} ASC NULLS FIRST' for c in _EV if c not in ('user_id', 'ts'))}) = 1""")
def q_keep_one_latest(spark, d):
    return R.keep_one(TT.read(spark, d, "events"), "user_id", ["ts"])


# ========================================================= U: upserts

@register("upsert_generic", """
    WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, true AS _t
               FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01'),
         s AS (SELECT o_orderkey, o_custkey,
                      CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
                      o_totalprice + 1.0 AS o_totalprice, o_orderdate, true AS _s
               FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
         j AS (SELECT t.o_orderkey AS t_k, s.o_orderkey AS s_k, t.o_custkey AS t_c, s.o_custkey AS s_c,
                      t.o_orderstatus AS t_st, s.o_orderstatus AS s_st, t.o_totalprice AS t_p,
                      s.o_totalprice AS s_p, t.o_orderdate AS t_d, s.o_orderdate AS s_d,
                      CASE WHEN t._t AND s._s AND coalesce(t.o_orderstatus <> s.o_orderstatus, false)
                           THEN 'update' WHEN t._t AND s._s THEN 'keep' WHEN s._s THEN 'insert'
                           ELSE 'keep' END AS _action
               FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey)
    SELECT CASE WHEN _action = 'insert' THEN s_k ELSE t_k END AS o_orderkey,
           CASE WHEN _action = 'insert' THEN s_c ELSE t_c END AS o_custkey,
           CASE WHEN _action = 'keep' THEN t_st ELSE s_st END AS o_orderstatus,
           CASE WHEN _action = 'keep' THEN t_p ELSE s_p END AS o_totalprice,
           CASE WHEN _action = 'insert' THEN s_d ELSE t_d END AS o_orderdate,
           _action
    FROM j""")
def q_upsert_generic(spark, d):
    o = TT.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                          "o_totalprice", "o_orderdate")
    tgt = o.filter(F.col("o_orderdate") <= F.lit("1998-01-01").cast("timestamp_ntz"))
    src = (o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
           .join(TT.read(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey")
           .select("o_orderkey", "o_custkey",
                   F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("U"))
                    .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
                   (F.col("o_totalprice") + 1.0).alias("o_totalprice"), "o_orderdate"))
    return U.upsert(tgt, src, "o_orderkey", "o_orderstatus", ["o_orderstatus", "o_totalprice"], B2)


@register("upsert_orders", _sql(MERGED_ORDERS, *ORD_RAW))
def q_upsert_orders(spark, d):
    return no_load_ts(merged_orders(spark, d))


@register("upsert_order_items", _sql(_child_sql("order_items"), *ORD_RAW, *CHILD_RAW["order_items"]))
def q_upsert_items(spark, d):
    return no_load_ts(merged_child(spark, d, "order_items"))


@register("upsert_order_payments", _sql(_child_sql("order_payments"), *ORD_RAW,
                                        *CHILD_RAW["order_payments"]))
def q_upsert_payments(spark, d):
    return no_load_ts(merged_child(spark, d, "order_payments"))


@register("upsert_order_reviews", _sql(_child_sql("order_reviews"), *ORD_RAW,
                                       *CHILD_RAW["order_reviews"]))
def q_upsert_reviews(spark, d):
    return no_load_ts(merged_child(spark, d, "order_reviews"))


@register("newer_than", _sql(f"SELECT order_id, order_purchase_timestamp FROM raw_orders_b2 "
                             f"WHERE order_purchase_timestamp > {MARK}", *ORD_RAW))
def q_newer_than(spark, d):
    mark = L.current_mark(spark, target_orders(spark, d))
    return U.newer_than(TT.raw_orders_batch2(spark, d), "order_purchase_timestamp", mark) \
            .select("order_id", "order_purchase_timestamp")


@register("merge_stats", _sql(
    "SELECT CAST(count_if(_action = 'insert') AS BIGINT) AS inserted, "
    "CAST(count_if(_action = 'update') AS BIGINT) AS updated, "
    "CAST(count_if(_action = 'keep') AS BIGINT) AS kept, count(*) AS total "
    f"FROM ({MERGED_ORDERS})", *ORD_RAW))
def q_merge_stats(spark, d):
    return U.merge_stats(merged_orders(spark, d))


# ================================================== Q: quality checks

def _sample_sql(rel: str, col: str = "order_id") -> str:
    return (f"(SELECT coalesce(CAST(to_json(list({col} ORDER BY {col} NULLS FIRST)) AS VARCHAR), '[]') "
            f"FROM (SELECT {col} FROM {rel} ORDER BY {col} NULLS FIRST LIMIT 5))")


CUR_ORDERS_SQL = f"({O.curated_orders_sql()})"
CUR_ITEMS_SQL = f"({O.curated_items_sql()})"
CUR_PAY_SQL = f"({O.curated_payments_sql()})"

DQ_SQL = {
    "dq_not_null": (
        "SELECT CAST(count_if(order_id IS NULL OR customer_id IS NULL OR order_status IS NULL) AS BIGINT) "
        "AS affected_count, count(*) AS total_count, "
        + _sample_sql("(SELECT * FROM raw_orders_gaps WHERE order_id IS NULL OR customer_id IS NULL "
                      "OR order_status IS NULL)") + " AS sample_ids FROM raw_orders_gaps",
        ("raw_orders_gaps",)),
    "dq_domain": (
        "SELECT CAST(count_if(order_status NOT IN ('p', 'f')) AS BIGINT) AS affected_count, "
        "count(*) AS total_count, "
        + _sample_sql(f"(SELECT * FROM {CUR_ORDERS_SQL} WHERE order_status NOT IN ('p', 'f'))")
        + f" AS sample_ids FROM {CUR_ORDERS_SQL}", ("raw_orders", "raw_customers")),
    "dq_foreign_key": (
        f"SELECT (SELECT count(*) FROM orph) AS affected_count, "
        f"(SELECT count(*) FROM {CUR_ITEMS_SQL}) AS total_count, "
        + _sample_sql("orph") + " AS sample_ids",
        ("raw_order_items", "raw_orders", "raw_customers")),
    "dq_unique": (
        "SELECT CAST(coalesce((SELECT sum(cnt - 1) FROM dup), 0) AS BIGINT) AS affected_count, "
        "(SELECT count(*) FROM raw_orders) AS total_count, " + _sample_sql("dup") + " AS sample_ids",
        ("raw_orders",)),
    "dq_date_order": (
        "SELECT CAST(count_if(order_delivered_customer_date IS NOT NULL AND "
        "order_delivered_customer_date < order_purchase_timestamp) AS BIGINT) AS affected_count, "
        "count(*) AS total_count, "
        + _sample_sql(f"(SELECT * FROM {CUR_ORDERS_SQL} WHERE order_delivered_customer_date IS NOT NULL "
                      "AND order_delivered_customer_date < order_purchase_timestamp)")
        + f" AS sample_ids FROM {CUR_ORDERS_SQL}", ("raw_orders", "raw_customers")),
    "dq_keys_present": (
        "SELECT (SELECT count(*) FROM miss) AS affected_count, "
        f"(SELECT count(DISTINCT order_id) FROM {CUR_PAY_SQL}) AS total_count, "
        + _sample_sql("miss") + " AS sample_ids",
        ("raw_order_payments", "raw_order_items")),
}
DQ_EXTRA = {
    "dq_foreign_key": f"orph AS (SELECT i.order_id FROM {CUR_ITEMS_SQL} i LEFT JOIN ({TGT_ORDERS}) o "
                      "USING (order_id) WHERE o.order_id IS NULL)",
    "dq_unique": "dup AS (SELECT order_id, count(*) AS cnt FROM raw_orders GROUP BY order_id "
                 "HAVING count(*) > 1)",
    "dq_keys_present": f"miss AS (SELECT DISTINCT p.order_id FROM {CUR_PAY_SQL} p WHERE NOT EXISTS "
                       f"(SELECT 1 FROM {CUR_ITEMS_SQL} i WHERE i.order_id = p.order_id))",
}


def _dq_sql(name):
    body, raws = DQ_SQL[name]
    return O.with_raw(body, *raws, extra=DQ_EXTRA.get(name, ""))


def test_checks(spark, d) -> list:
    """The six checks over the test adaptations (catalog {p, f}, orphans
    against the first-load orders)."""
    # the checks run on written curated tables: materialise the inputs that
    # several checks read
    from ..context import work_root
    work_root(spark)
    orders = C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d)).checkpoint()
    items = C.curate_order_items(TT.raw_order_items(spark, d)).checkpoint()
    payments = C.curate_order_payments(TT.raw_order_payments(spark, d))   # used once
    checks = Q.standard_checks(TT.raw_orders_with_gaps(spark, d), orders, items, payments,
                               catalog=TT.STATUS_CATALOG_TEST)
    # parent of the orphan check: the first-load orders, i.e. the curated
    # orders (already materialised above) up to the cutoff
    first_load = orders.filter(F.col("order_purchase_timestamp") <= TT.cutoff())
    checks[2].frame = Q.check_foreign_key(items, first_load, "order_id")
    checks[3].frame = Q.check_unique(TT.raw_orders(spark, d), "order_id")
    return checks


@register("dq_not_null", _dq_sql("dq_not_null"))
def q_dq_not_null(spark, d):
    return Q.check_not_null(TT.raw_orders_with_gaps(spark, d),
                            ["order_id", "customer_id", "order_status"], "order_id")


@register("dq_domain", _dq_sql("dq_domain"))
def q_dq_domain(spark, d):
    cur = C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d))
    return Q.check_domain(cur, "order_status", TT.STATUS_CATALOG_TEST, "order_id")


@register("dq_foreign_key", _dq_sql("dq_foreign_key"))
def q_dq_fk(spark, d):
    return Q.check_foreign_key(C.curate_order_items(TT.raw_order_items(spark, d)),
                               target_orders(spark, d), "order_id")


@register("dq_unique", _dq_sql("dq_unique"))
def q_dq_unique(spark, d):
    return Q.check_unique(TT.raw_orders(spark, d), "order_id")


@register("dq_date_order", _dq_sql("dq_date_order"))
def q_dq_date_order(spark, d):
    cur = C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d))
    return Q.check_order(cur, "order_purchase_timestamp", "order_delivered_customer_date", "order_id")


@register("dq_keys_present", _dq_sql("dq_keys_present"))
def q_dq_keys_present(spark, d):
    return Q.check_keys_present(C.curate_order_payments(TT.raw_order_payments(spark, d)),
                                C.curate_order_items(TT.raw_order_items(spark, d)), "order_id")


_CHECK_META = [(name, *Q.STANDARD_META[name], q) for name, q in zip(
    Q.STANDARD_META,
    ["dq_not_null", "dq_domain", "dq_foreign_key", "dq_unique", "dq_date_order", "dq_keys_present"])]


def _dq_all_sql() -> str:
    ctes = []
    for name in DQ_EXTRA:
        ctes.append(DQ_EXTRA[name])
    parts = []
    for c_name, desc, tbl, sev, q in _CHECK_META:
        body, _ = DQ_SQL[q]
        parts.append(
            f"SELECT 'b1' AS batch_id, '{c_name}' AS check_name, '{desc}' AS check_description, "
            f"'{tbl}' AS table_name, '{sev}' AS severity, "
            "CASE WHEN coalesce(affected_count, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            "CAST(coalesce(affected_count, 0) AS BIGINT) AS affected_count, "
            f"CAST(coalesce(total_count, 0) AS BIGINT) AS total_count, sample_ids FROM ({body})")
    raws = ["raw_orders", "raw_customers", "raw_orders_gaps", "raw_order_items", "raw_order_payments"]
    return O.with_raw(" UNION ALL ".join(parts), *raws, extra=",\n  ".join(ctes))


DQ_ALL = _dq_all_sql()
DQ_ALL_BODY = DQ_ALL[DQ_ALL.index("SELECT 'b1' AS batch_id"):]
DQ_ALL_WITH = DQ_ALL[:DQ_ALL.index("SELECT 'b1' AS batch_id")]


def dq_results(spark, d):
    return Q.run_checks(spark, test_checks(spark, d), B1).drop("check_timestamp")


@register("dq_run_all", DQ_ALL)
def q_dq_run_all(spark, d):
    return dq_results(spark, d)


@register("dq_pct", DQ_ALL_WITH + (
    "SELECT check_name, affected_count, total_count, CASE WHEN total_count <> 0 THEN "
    "printf('%.2f%%', affected_count / total_count * 100) ELSE 'n/a' END AS violation_pct "
    f"FROM ({DQ_ALL_BODY})"))
def q_dq_pct(spark, d):
    return Q.with_pct(dq_results(spark, d)).select("check_name", "affected_count", "total_count",
                                                   "violation_pct")


@register("dq_summary", DQ_ALL_WITH + (
    "SELECT CAST(count_if(status = 'PASS') AS BIGINT) AS passed, "
    "CAST(count_if(status = 'FAIL') AS BIGINT) AS failed, "
    "CAST(count_if(status = 'ERROR') AS BIGINT) AS errored, count(*) AS total "
    f"FROM ({DQ_ALL_BODY})"))
def q_dq_summary(spark, d):
    return Q.summarize_checks(dq_results(spark, d))


@register("dq_gate", DQ_ALL_WITH + (
    f"SELECT check_name, severity, status FROM ({DQ_ALL_BODY}) "
    "WHERE severity = 'CRITICAL' AND status = 'FAIL'"))
def q_dq_gate(spark, d):
    return Q.critical_failures(dq_results(spark, d)).select("check_name", "severity", "status")


@register("report_dq", DQ_ALL_WITH + (
    "SELECT check_name, severity, status, affected_count, total_count, sample_ids "
    f"FROM ({DQ_ALL_BODY})"))
def q_report_dq(spark, d):
    res = Q.run_checks(spark, test_checks(spark, d), B1)
    return OPS.report_dq(res).drop("check_timestamp")


@register("report_failures", DQ_ALL_WITH + (
    f"SELECT * FROM ({DQ_ALL_BODY}) WHERE status = 'FAIL'"))
def q_report_failures(spark, d):
    res = Q.run_checks(spark, test_checks(spark, d), B1)
    return OPS.report_failures(res).drop("check_timestamp")


# ============================================ S: sources and sinks (I/O)

from ..context import new_run_dir  # noqa: E402
from ..sources import csv as CSV  # noqa: E402
from ..sources import sinks as SK  # noqa: E402
from ..sources import versions as V  # noqa: E402

_REVIEW_RAW_COLS = ["review_id", "order_id", "review_score", "review_comment_title",
                    "review_comment_message", "review_creation_date", "review_answer_timestamp"]


def _reviews_multiline(spark, d):
    """Raw reviews whose message spans two lines (quoted newline in CSV)."""
    r = TT.raw_order_reviews(spark, d)
    return r.withColumn("review_comment_message",
                        F.concat(F.col("review_comment_message"), F.lit("\n"),
                                 F.col("review_comment_title")))


@register("csv_roundtrip", _sql(
    "SELECT CAST(review_id AS BIGINT) AS review_id, CAST(order_id AS BIGINT) AS order_id, "
    "CAST(review_score AS BIGINT) AS review_score, review_comment_title, "
    "review_comment_message || chr(10) || review_comment_title AS review_comment_message, "
    "review_creation_date, review_answer_timestamp FROM raw_order_reviews", "raw_order_reviews"))
def q_csv_roundtrip(spark, d):
    path = new_run_dir(spark, "csv-roundtrip")
    CSV.write_csv(_reviews_multiline(spark, d), path)
    good, _ = CSV.read_raw_csv(spark, path, CSV.string_schema(_REVIEW_RAW_COLS), max_bad=0,
                               multiline=True)
    return good.select(P.cast_strict("review_id", "int64").alias("review_id"),
                       P.cast_strict("order_id", "int64").alias("order_id"),
                       P.cast_strict("review_score", "int64").alias("review_score"),
                       "review_comment_title", "review_comment_message",
                       P.cast_strict("review_creation_date", "timestamp").alias("review_creation_date"),
                       P.cast_strict("review_answer_timestamp", "timestamp").alias("review_answer_timestamp"))


_ITEM_RAW_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
                  "price", "freight_value"]


@register("csv_lenient", _sql(
    "SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id, "
    "shipping_limit_date, price, freight_value FROM raw_order_items WHERE order_item_id <> 7",
    "raw_order_items"))
def q_csv_lenient(spark, d):
    # every 7th line number is written with one field too many (malformed)
    path = new_run_dir(spark, "csv-lenient")
    raw = TT.raw_order_items(spark, d)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _ITEM_RAW_COLS]
    line = F.concat_ws(",", *fields)
    line = F.when(F.col("order_item_id") == 7, F.concat(line, F.lit(",extra"))).otherwise(line)
    raw.select(line.alias("value")).write.mode("overwrite").text(path)
    good, _ = CSV.read_raw_csv(spark, path, CSV.string_schema(_ITEM_RAW_COLS),
                               max_bad=raw.filter("order_item_id = 7").count(), header=False)
    return good.select(P.cast_strict("order_id", "int64").alias("order_id"),
                       P.cast_strict("order_item_id", "int64").alias("order_item_id"),
                       P.cast_strict("product_id", "int64").alias("product_id"),
                       P.cast_strict("seller_id", "int64").alias("seller_id"),
                       P.cast_strict("shipping_limit_date", "timestamp").alias("shipping_limit_date"),
                       P.cast_strict("price", "float64").alias("price"),
                       P.cast_strict("freight_value", "float64").alias("freight_value"))


@register("raw_overwrite_twice", _sql("SELECT * FROM raw_sellers", "raw_sellers"))
def q_raw_overwrite_twice(spark, d):
    path = new_run_dir(spark, "raw-overwrite")
    SK.write_full(TT.raw_sellers(spark, d), path)
    SK.write_full(TT.raw_sellers(spark, d), path)      # truncate-and-load: no doubling
    return spark.read.parquet(path)


def _count_log_rows(spark, d, batch):
    parts = [R.row_count(df, "records_read").select(
        F.lit(batch).alias("batch_id"), F.lit("FULL").alias("run_type"),
        F.lit(n).alias("table_name"), "records_read")
        for n, df in _raw_frames(spark, d).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("run_timestamp", P.ntz_lit(B1.run_ts))


@register("ops_append", _sql(" UNION ALL ".join(
    f"SELECT '{b}' AS batch_id, 'FULL' AS run_type, '{n}' AS table_name, count(*) AS records_read "
    f"FROM {n}" for b in ("b1", "b2") for n in _RAW_NAMES), *_RAW_NAMES))
def q_ops_append(spark, d):
    root = new_run_dir(spark, "ops")
    SK.ensure_ops_tables(spark, root)
    SK.ensure_ops_tables(spark, root)                  # idempotent
    for b in ("b1", "b2"):
        SK.append_log(_count_log_rows(spark, d, b), f"{root}/pipeline_run_log", SK.RUN_LOG_SCHEMA)
    return spark.read.parquet(f"{root}/pipeline_run_log").select(
        "batch_id", "run_type", "table_name", "records_read")


_INGEST = {"sellers.csv": ("raw_sellers", ["seller_id", "seller_zip_code_prefix", "seller_city",
                                           "seller_state"]),
           "reviews.csv": ("raw_order_reviews", _REVIEW_RAW_COLS),
           "geolocation.csv": ("raw_geolocation", ["zip"])}


@register("ingest_all_report", _sql(
    "SELECT 'raw_sellers' AS table_name, 'sellers.csv' AS file_name, count(*) AS rows_loaded, "
    "CAST(0 AS BIGINT) AS rows_rejected, 'LOADED' AS status FROM raw_sellers UNION ALL "
    "SELECT 'raw_order_reviews', 'reviews.csv', count(*), 0, 'LOADED' FROM raw_order_reviews UNION ALL "
    "SELECT 'raw_geolocation', 'geolocation.csv', 0, 0, 'MISSING'", "raw_sellers", "raw_order_reviews"))
def q_ingest_all(spark, d):
    src = new_run_dir(spark, "landing")
    CSV.write_csv(TT.raw_sellers(spark, d), f"{src}/sellers.csv")
    CSV.write_csv(_reviews_multiline(spark, d), f"{src}/reviews.csv")
    rep = CSV.ingest_all(spark, src, _INGEST, new_run_dir(spark, "raw"), "b1",
                         budgets={"raw_order_reviews": 1000}, multiline=["raw_order_reviews"])
    return rep.drop("error_message")


@register("write_curated_snapshot", _sql(O.curated_sellers_sql(), "raw_sellers"))
def q_write_snapshot(spark, d):
    root = new_run_dir(spark, "curated") + "/sellers"
    SK.write_snapshot(C.curate_sellers(TT.raw_sellers(spark, d), B1), root, "b1")
    return no_load_ts(SK.read_current(spark, root))


# ===================================================== C7/U9: the loads

def _raw_tables(spark, d, batch: int) -> L.RawTables:
    orders = TT.raw_orders(spark, d)
    if batch == 1:      # first extract: orders purchased up to the cutoff
        orders = orders.filter(F.col("order_purchase_timestamp") <= TT.cutoff())
    else:
        orders = TT.raw_orders_batch2(spark, d)
    return L.RawTables({
        "orders": orders, "customers": TT.raw_customers(spark, d),
        "order_items": TT.raw_order_items(spark, d, reprice=batch == 2),
        "order_payments": TT.raw_order_payments(spark, d, reprice=batch == 2),
        "order_reviews": TT.raw_order_reviews(spark, d),
        "products": TT.raw_products(spark, d),
        "category_translation": TT.raw_category_translation(spark, d),
        "sellers": TT.raw_sellers(spark, d)})


_LOG_COLS = ["batch_id", "run_type", "table_name", "records_read", "records_inserted",
             "records_updated", "records_skipped", "status"]

RAW_B1_ORDERS = f"(SELECT * FROM raw_orders WHERE order_purchase_timestamp <= {O.CUTOFF})"
FULL_COUNTS = {
    "sellers": ("raw_sellers", f"({O.curated_sellers_sql()})"),
    "products": ("raw_products", f"({O.curated_products_sql()})"),
    "orders": (RAW_B1_ORDERS, f"({O.curated_orders_sql('b1', RAW_B1_ORDERS)})"),
    "order_items": ("raw_order_items", f"({O.curated_items_sql()})"),
    "order_payments": ("raw_order_payments", f"({O.curated_payments_sql()})"),
    "order_reviews": ("raw_order_reviews", f"({O.curated_reviews_sql()})"),
}
ALL_RAW = ("raw_orders", "raw_customers", "raw_orders_b2", "raw_order_items", "raw_order_items_b2",
           "raw_order_payments", "raw_order_payments_b2", "raw_order_reviews", "raw_products",
           "raw_category_translation", "raw_sellers")


def _full_summary_sql() -> str:
    parts = []
    for t in L.FULL_ORDER:
        raw, cur = FULL_COUNTS[t]
        r_n, c_n = f"(SELECT count(*) FROM {raw})", f"(SELECT count(*) FROM {cur})"
        parts.append(
            f"SELECT 'b1' AS batch_id, 'FULL' AS run_type, '{t}' AS table_name, {r_n} AS records_read, "
            f"{c_n} AS records_inserted, CAST(0 AS BIGINT) AS records_updated, "
            f"greatest({r_n} - {c_n}, 0) AS records_skipped, 'SUCCESS' AS status")
    return O.with_raw(" UNION ALL ".join(parts), *ALL_RAW)


def _full_load(spark, d):
    root = new_run_dir(spark, "lake")
    log = L.full_load(spark, _raw_tables(spark, d, 1), f"{root}/curated", B1,
                      ops_root=f"{root}/ops")
    return root, log


@register("full_load_summary", _full_summary_sql())
def q_full_load_summary(spark, d):
    _, log = _full_load(spark, d)
    return log.select(*_LOG_COLS)


# incremental after the full load above
INC_TGT_ORDERS = O.curated_orders_sql("b1", RAW_B1_ORDERS)
INC_MARK = f"(SELECT coalesce(max(order_purchase_timestamp), TIMESTAMP '2000-01-01') FROM ({INC_TGT_ORDERS}))"
INC_SRC_ORDERS = (f"SELECT * EXCLUDE (_source_file, _batch_id) FROM "
                  f"({O.curated_orders_sql('b2', 'raw_orders_b2')}) WHERE order_purchase_timestamp > {INC_MARK}")
INC_MERGED_ORDERS = O.merge_sql(INC_TGT_ORDERS, INC_SRC_ORDERS, ["order_id"], "order_status",
                                L.MERGE_RULES["orders"][2], ORDER_OUT, C.SOURCE_LABELS["orders"], "b2")


def _inc_child_sql(table):
    cur = {"order_items": O.curated_items_sql, "order_payments": O.curated_payments_sql,
           "order_reviews": O.curated_reviews_sql}[table]
    cols = {"order_items": C.ITEM_COLS, "order_payments": C.PAYMENT_COLS,
            "order_reviews": C.REVIEW_COLS}[table] + ["_source_file", "_batch_id"]
    b2src = {"order_items": "raw_order_items_b2", "order_payments": "raw_order_payments_b2",
             "order_reviews": "raw_order_reviews"}[table]
    touched = f"(SELECT order_id FROM ({INC_MERGED_ORDERS}) WHERE _batch_id = 'b2')"
    src = (f"SELECT * EXCLUDE (_source_file, _batch_id) FROM "
           f"({cur('b2', f'(SELECT * FROM {b2src} WHERE order_id IN {touched})')})")
    keys, change, upd = L.MERGE_RULES[table]
    return O.merge_sql(cur("b1"), src, keys, change, upd, cols, C.SOURCE_LABELS[table], "b2")


def _inc_summary_sql() -> str:
    parts = [
        "SELECT 'b2' AS batch_id, 'INCREMENTAL' AS run_type, 'sellers' AS table_name, count(*) AS records_read, "
        "count(*) AS records_inserted, CAST(0 AS BIGINT) AS records_updated, CAST(0 AS BIGINT) AS records_skipped, "
        f"'SUCCESS' AS status FROM ({O.curated_sellers_sql()})",
        "SELECT 'b2', 'INCREMENTAL', 'products', count(*), count(*), 0, 0, 'SUCCESS' "
        f"FROM ({O.curated_products_sql()})"]
    merged = {"orders": INC_MERGED_ORDERS, "order_items": _inc_child_sql("order_items"),
              "order_payments": _inc_child_sql("order_payments"),
              "order_reviews": _inc_child_sql("order_reviews")}
    for t in L.FACTS:
        parts.append(f"SELECT 'b2', 'INCREMENTAL', '{t}', count(*), CAST(count_if(_action = 'insert') AS BIGINT), "
                     f"CAST(count_if(_action = 'update') AS BIGINT), 0, 'SUCCESS' FROM ({merged[t]})")
    return O.with_raw(" UNION ALL ".join(parts), *ALL_RAW)


B2_LOAD = RunContext(batch_id=TT.BATCH_2)


@register("incremental_load_summary", _inc_summary_sql())
def q_incremental_summary(spark, d):
    root, _ = _full_load(spark, d)
    log = L.incremental_load(spark, _raw_tables(spark, d, 2), f"{root}/curated", B2_LOAD,
                             ops_root=f"{root}/ops")
    return log.select(*_LOG_COLS)


@register("refresh_dimensions", O.with_raw(
    f"SELECT * FROM ({O.curated_sellers_sql('b2')}) ", "raw_sellers"))
def q_refresh_dimensions(spark, d):
    root, _ = _full_load(spark, d)
    L.incremental_load(spark, _raw_tables(spark, d, 2), f"{root}/curated", B2_LOAD)
    return no_load_ts(SK.read_current(spark, f"{root}/curated/sellers"))


_FULL_SUMMARY = _full_summary_sql()
_FS_BODY = _FULL_SUMMARY[_FULL_SUMMARY.index("SELECT 'b1' AS batch_id"):]
_FS_WITH = _FULL_SUMMARY[:_FULL_SUMMARY.index("SELECT 'b1' AS batch_id")]


def _days_back(col):
    """Log rows of one run moved to distinct days, so that order can be seen."""
    return F.col(col) - F.make_interval(days=F.length("table_name" if col == "run_timestamp" else "check_name"))


def _numbered(df):
    """The report's order as a column. ``monotonically_increasing_id`` follows
    the sorted partitions; the rank of it is their position."""
    from pyspark.sql.window import Window
    return (df.withColumn("_i", F.monotonically_increasing_id())
              .withColumn("position", F.row_number().over(Window.orderBy("_i")).cast("bigint")).drop("_i"))


@register("report_runs", _FS_WITH + (
    "SELECT table_name, run_type, records_inserted, records_updated, status, "
    "rank() OVER (ORDER BY length(table_name)) AS day_rank "
    f"FROM ({_FS_BODY})"))
def q_report_runs(spark, d):
    root, _ = _full_load(spark, d)
    log = spark.read.parquet(f"{root}/ops/pipeline_run_log").filter("status <> 'STARTED'") \
               .withColumn("run_timestamp", _days_back("run_timestamp"))
    r = _numbered(OPS.report_runs(log))
    # equal times may come in any order: their first position is compared
    from pyspark.sql.window import Window
    return r.withColumn("day_rank", F.min("position").over(Window.partitionBy("run_timestamp"))) \
            .drop("duration_seconds", "run_timestamp", "position")


# ===================================== X: operational extensions (stretch)

from ..plans import contracts as X  # noqa: E402


@register("partitioned_month_read", _sql(
    "SELECT order_id, strftime(order_purchase_timestamp, '%Y-%m') AS month "
    f"FROM ({O.curated_orders_sql()}) WHERE strftime(order_purchase_timestamp, '%Y-%m') "
    "BETWEEN '1996-01' AND '1996-12'", "raw_orders", "raw_customers"))
def q_partitioned_month(spark, d):
    # Month-partitioned layout; the read filters on the partition column,
    # so only twelve month folders are listed and scanned
    path = new_run_dir(spark, "orders-by-month")
    cur = X.with_month(C.curate_orders(TT.raw_orders(spark, d), TT.raw_customers(spark, d), B1),
                       "order_purchase_timestamp")
    SK.write_full(cur, path, partition_by=["month"], sort_within=["order_id"])
    back = spark.read.parquet(path)
    return back.filter(F.col("month").cast("string").between("1996-01", "1996-12")) \
               .select("order_id", F.col("month").cast("string").alias("month"))


_LIMITS = {"orphan_order_items": 0.001, "invalid_order_status": 0.5,
           "duplicate_order_ids_raw": 0.05}


@register("dq_threshold", DQ_ALL_WITH + (
    "SELECT check_name, CAST(coalesce(CASE check_name "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _LIMITS.items())
    + " END, 0.0) AS DOUBLE) AS threshold, coalesce(CASE WHEN total_count > 0 THEN "
    "affected_count / total_count END > coalesce(CASE check_name "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _LIMITS.items())
    + f" END, 0.0), false) AS alert FROM ({DQ_ALL_BODY})"))
def q_dq_threshold(spark, d):
    return X.with_threshold(dq_results(spark, d), _LIMITS, default=0.0) \
            .select("check_name", "threshold", "alert")


@register("pending_tables", "SELECT * FROM (VALUES ('order_items', 3), ('order_payments', 4), "
                            "('order_reviews', 5)) AS t(table_name, position)")
def q_pending_tables(spark, d):
    # A batch that stopped after the dimensions and orders: the three
    # child tables are what a resume has to run
    root = new_run_dir(spark, "lake")
    L.full_load(spark, _raw_tables(spark, d, 1), f"{root}/curated", B1, ops_root=f"{root}/ops",
                tables=["sellers", "products", "orders"])
    log = spark.read.parquet(f"{root}/ops/pipeline_run_log")
    return X.pending_tables(spark, log, B1.batch_id, L.FULL_ORDER)


@register("split_rejects", _sql(
    "SELECT order_id, order_item_id, concat_ws(',', CASE WHEN price IS NULL THEN 'price_missing' END, "
    "CASE WHEN freight_value = 0 THEN 'freight_zero' END) AS reject_reason, 'b1' AS _batch_id "
    "FROM raw_order_items WHERE price IS NULL OR freight_value = 0", "raw_order_items"))
def q_split_rejects(spark, d):
    _, rej = X.split_rejects(TT.raw_order_items(spark, d),
                             {"price_missing": F.col("price").isNull(),
                              "freight_zero": F.col("freight_value") == 0}, B1)
    return rej.select("order_id", "order_item_id", "reject_reason", "_batch_id")


@register("contract_daily_volume", _sql(
    "SELECT day, coalesce(n, 0) AS rows FROM (SELECT CAST(unnest(generate_series(min(order_purchase_timestamp)::DATE, "
    "max(order_purchase_timestamp)::DATE, INTERVAL 1 DAY)) AS DATE) AS day FROM raw_orders) "
    "LEFT JOIN (SELECT CAST(order_purchase_timestamp AS DATE) AS day, count(*) AS n FROM raw_orders GROUP BY 1) "
    "USING (day) WHERE coalesce(n, 0) < 5", "raw_orders"))
def q_contract_daily(spark, d):
    return X.daily_volume_breaches(TT.raw_orders(spark, d), "order_purchase_timestamp", 5)


_MASKED = ["customer_unique_id", "customer_zip_code_prefix", "customer_city"]


@register("mask_pii", _sql("SELECT customer_id, " + ", ".join(f"sha256('k1:' || {c}) AS {c}" for c in _MASKED)
                           + ", customer_state FROM raw_customers", "raw_customers"))
def q_mask_pii(spark, d):
    return X.mask(TT.raw_customers(spark, d), _MASKED, key="k1") \
            .select("customer_id", *_MASKED, "customer_state")


# ============== incremental upsert that rewrites only the touched months

def _month(df):
    return F.date_format(F.col("order_purchase_timestamp"), "yyyy-MM")


def _orders_by_month(spark, d):
    """First load written month-partitioned, then the second batch merged
    into the touched months only. Returns (root, touched months)."""
    root = new_run_dir(spark, "orders-by-month")
    raw1 = _raw_tables(spark, d, 1)
    first = X.with_month(C.curate_orders(raw1["orders"], raw1["customers"], B1),
                         "order_purchase_timestamp")
    V.replace(first, root, "b1", ["month"])
    mark = L.current_mark(spark, V.read(spark, root))
    raw2 = _raw_tables(spark, d, 2)
    src = L.orders_delta(raw2, mark, B2)
    keys, change, upd = L.MERGE_RULES["orders"]
    res = U.upsert_partitions(spark, root, src, keys, change, upd, B2, "month", _month,
                              source_label=C.SOURCE_LABELS["orders"])
    return root, res["partitions"]


@register("upsert_orders_by_month", _sql(
    f"SELECT * EXCLUDE (_action), strftime(order_purchase_timestamp, '%Y-%m') AS month "
    f"FROM ({INC_MERGED_ORDERS})", *ALL_RAW))
def q_upsert_by_month(spark, d):
    root, _ = _orders_by_month(spark, d)
    return no_load_ts(V.read(spark, root))


@register("upsert_touched_months", _sql(
    f"SELECT DISTINCT strftime(order_purchase_timestamp, '%Y-%m') AS month FROM ({INC_SRC_ORDERS}) "
    f"UNION SELECT strftime(t.order_purchase_timestamp, '%Y-%m') FROM ({INC_TGT_ORDERS}) t "
    f"WHERE t.order_id IN (SELECT order_id FROM ({INC_SRC_ORDERS}))", *ALL_RAW))
def q_touched_months(spark, d):
    _, months = _orders_by_month(spark, d)
    return spark.createDataFrame([(m,) for m in months], "month string")



# ====================== delta options: look-back window and late updates

def _late_merge(spark, d, lookback_days=0, late_updates=False):
    from ..context import work_root
    work_root(spark)
    tgt = target_orders(spark, d).checkpoint(eager=True)
    mark = L.current_mark(spark, tgt)
    raw = L.RawTables({"orders": TT.raw_orders_batch2_late(spark, d),
                       "customers": TT.raw_customers(spark, d)})
    src = L.orders_delta(raw, mark, B2, lookback_days=lookback_days, late_updates=late_updates,
                         target=tgt)
    return no_load_ts(L.merge_table("orders", tgt, src, B2))


_LATE_CLEAN = f"({O.curated_orders_sql('b2', 'raw_orders_b2_late')})"
_LATE_RAW = ("raw_orders", "raw_customers", "raw_orders_b2", "raw_orders_b2_late")


def _late_src(where: str) -> str:
    return f"SELECT * EXCLUDE (_source_file, _batch_id) FROM {_LATE_CLEAN} s WHERE {where}"


_LATE_DEFAULT = O.merge_sql(TGT_ORDERS, _late_src(f"order_purchase_timestamp > {MARK}"),
                            ["order_id"], "order_status", L.MERGE_RULES["orders"][2], ORDER_OUT,
                            C.SOURCE_LABELS["orders"], "b2")
_LATE_LOOKBACK = O.merge_sql(TGT_ORDERS, _late_src(
    f"order_purchase_timestamp > {MARK} - INTERVAL 400 DAY"), ["order_id"], "order_status",
    L.MERGE_RULES["orders"][2], ORDER_OUT, C.SOURCE_LABELS["orders"], "b2")
_LATE_UPDATES = O.merge_sql(TGT_ORDERS, _late_src(
    f"order_purchase_timestamp > {MARK} OR EXISTS (SELECT 1 FROM ({TGT_ORDERS}) t "
    "WHERE t.order_id = s.order_id AND t.order_status <> s.order_status)"),
    ["order_id"], "order_status", L.MERGE_RULES["orders"][2], ORDER_OUT,
    C.SOURCE_LABELS["orders"], "b2")


@register("delta_default_misses_late_changes", _sql(_LATE_DEFAULT, *_LATE_RAW))
def q_delta_default(spark, d):
    return _late_merge(spark, d)


@register("delta_lookback", _sql(_LATE_LOOKBACK, *_LATE_RAW))
def q_delta_lookback(spark, d):
    return _late_merge(spark, d, lookback_days=400)


@register("delta_late_updates", _sql(_LATE_UPDATES, *_LATE_RAW))
def q_delta_late_updates(spark, d):
    return _late_merge(spark, d, late_updates=True)



_MONTH_LAYOUT = {"orders": ("month", _month)}


@register("incremental_load_by_month_summary", _inc_summary_sql())
def q_incremental_by_month(spark, d):
    root = new_run_dir(spark, "lake")
    L.full_load(spark, _raw_tables(spark, d, 1), f"{root}/curated", B1, layout=_MONTH_LAYOUT)
    log = L.incremental_load(spark, _raw_tables(spark, d, 2), f"{root}/curated", B2_LOAD,
                             layout=_MONTH_LAYOUT)
    return log.select(*_LOG_COLS)



def _inc_children_sql() -> str:
    full = _inc_summary_sql()
    body = full[full.index("SELECT 'b2' AS batch_id"):]
    head = full[:full.index("SELECT 'b2' AS batch_id")]
    return head + f"SELECT * FROM ({body}) WHERE table_name IN ('order_items', 'order_payments', 'order_reviews')"


@register("resume_incremental", _inc_children_sql())
def q_resume_incremental(spark, d):
    # the batch stops after dimensions and orders; the resume runs the three
    # children with the same batch id and must equal an uninterrupted run
    root = new_run_dir(spark, "lake")
    L.full_load(spark, _raw_tables(spark, d, 1), f"{root}/curated", B1, ops_root=f"{root}/ops")
    raw2 = _raw_tables(spark, d, 2)
    L.incremental_load(spark, raw2, f"{root}/curated", B2_LOAD, ops_root=f"{root}/ops",
                       tables=["sellers", "products", "orders"])
    log = spark.read.parquet(f"{root}/ops/pipeline_run_log")
    resumed = L.resume_incremental(spark, raw2, f"{root}/curated", B2_LOAD, log,
                                   ops_root=f"{root}/ops")
    return resumed.select(*_LOG_COLS)



# =================== quality run over the written tables of a full load

def _quality_run_sql() -> str:
    """The six checks over the full-load tables (raw orders with gaps for
    the null and duplicate checks, as in ``dq_run_all``)."""
    cur_o = f"({O.curated_orders_sql('b1', RAW_B1_ORDERS)})"
    cur_i, cur_p = f"({O.curated_items_sql()})", f"({O.curated_payments_sql()})"
    gaps = "(SELECT * FROM raw_orders_gaps)"
    s = _sample_sql
    checks = [
        ("null_mandatory_fields_orders", *Q.STANDARD_META["null_mandatory_fields_orders"],
         "SELECT count_if(order_id IS NULL OR customer_id IS NULL OR order_status IS NULL) AS a, "
         "count(*) AS t, " + s(f"(SELECT * FROM {gaps} WHERE order_id IS NULL OR customer_id IS NULL "
                                "OR order_status IS NULL)") + f" AS smp FROM {gaps}"),
        ("invalid_order_status", *Q.STANDARD_META["invalid_order_status"], "SELECT count_if(order_status NOT IN ('p', 'f')) AS a, count(*) AS t, "
         + s(f"(SELECT * FROM {cur_o} WHERE order_status NOT IN ('p', 'f'))") + f" AS smp FROM {cur_o}"),
        ("orphan_order_items", *Q.STANDARD_META["orphan_order_items"],
         f"SELECT (SELECT count(*) FROM qr_orph) AS a, (SELECT count(*) FROM {cur_i}) AS t, "
         + s("qr_orph") + " AS smp"),
        ("duplicate_order_ids_raw", *Q.STANDARD_META["duplicate_order_ids_raw"],
         "SELECT coalesce((SELECT sum(cnt - 1) FROM qr_dup), 0) AS a, "
         f"(SELECT count(*) FROM {gaps}) AS t, " + s("qr_dup") + " AS smp"),
        ("invalid_date_range_delivery", *Q.STANDARD_META["invalid_date_range_delivery"],
         "SELECT count_if(order_delivered_customer_date IS NOT NULL AND order_delivered_customer_date "
         "< order_purchase_timestamp) AS a, count(*) AS t, "
         + s(f"(SELECT * FROM {cur_o} WHERE order_delivered_customer_date IS NOT NULL AND "
             "order_delivered_customer_date < order_purchase_timestamp)") + f" AS smp FROM {cur_o}"),
        ("payments_without_items", *Q.STANDARD_META["payments_without_items"],
         f"SELECT (SELECT count(*) FROM qr_miss) AS a, (SELECT count(DISTINCT order_id) FROM {cur_p}) AS t, "
         + s("qr_miss") + " AS smp"),
    ]
    extra = ",\n  ".join([
        f"qr_orph AS (SELECT i.order_id FROM {cur_i} i LEFT JOIN {cur_o} o USING (order_id) "
        "WHERE o.order_id IS NULL)",
        f"qr_dup AS (SELECT order_id, count(*) AS cnt FROM {gaps} GROUP BY order_id HAVING count(*) > 1)",
        f"qr_miss AS (SELECT DISTINCT p.order_id FROM {cur_p} p WHERE NOT EXISTS "
        f"(SELECT 1 FROM {cur_i} i WHERE i.order_id = p.order_id))"])
    parts = [f"SELECT 'b1' AS batch_id, '{n}' AS check_name, '{desc}' AS check_description, "
             f"'{tbl}' AS table_name, '{sev}' AS severity, "
             "CASE WHEN coalesce(a, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
             "CAST(coalesce(a, 0) AS BIGINT) AS affected_count, "
             f"CAST(coalesce(t, 0) AS BIGINT) AS total_count, smp AS sample_ids FROM ({body})"
             for n, desc, tbl, sev, body in checks]
    return O.with_raw(" UNION ALL ".join(parts), "raw_orders", "raw_customers", "raw_orders_gaps",
                      "raw_order_items", "raw_order_payments", extra=extra)


@register("quality_run_report", _quality_run_sql())
def q_quality_run(spark, d):
    # full load, then the quality run over the written tables; the results
    # are read back from the ops table they were appended to
    root, _ = _full_load(spark, d)
    L.quality_run(spark, TT.raw_orders_with_gaps(spark, d), f"{root}/curated", B1,
                  ops_root=f"{root}/ops", catalog=TT.STATUS_CATALOG_TEST)
    return spark.read.parquet(f"{root}/ops/dq_results").drop("check_timestamp")


# ================= failure and resume, NULL partitions, replaced partitions

class _Lost(RuntimeError):
    pass


def _curated_facts(spark, root):
    """The whole rows of all fact tables in one frame, each with how often it is
    there: the table's name and all its columns but the load time, which are NULL
    in the rows of other tables."""
    out = None
    for t in L.FACTS:
        df = no_load_ts(SK.read_current(spark, f"{root}/curated/{t}"))
        df = df.withColumn("order_id", F.col("order_id").cast("bigint"))
        one = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(t))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def _fact_rows_sql(orders: str, children: dict[str, str]) -> str:
    return O.with_raw(" UNION ALL BY NAME ".join(
        f"SELECT '{t}' AS table_name, *, count(*) AS rows FROM ({sql}) GROUP BY ALL"
        for t, sql in {"orders": orders, **children}.items()), *ALL_RAW)


def _inc_rows_sql(more: str = "") -> str:
    """All rows after the second batch; ``more``: columns that the layout adds to the orders."""
    merged = lambda sql: f"SELECT * EXCLUDE (_action) FROM ({sql})"
    return _fact_rows_sql(f"SELECT * EXCLUDE (_action){more} FROM ({INC_MERGED_ORDERS})",
                          {t: merged(_inc_child_sql(t)) for t in L.FACTS[1:]})


def _fact_counts(spark, root):
    """Rows of all fact tables in one frame, by table, batch and order."""
    out = None
    for t in L.FACTS:
        df = SK.read_current(spark, f"{root}/curated/{t}").drop("_load_timestamp")
        one = df.select(F.lit(t).alias("table_name"), "_batch_id", F.col("order_id").cast("bigint").alias("order_id"))
        one = one.groupBy("table_name", "_batch_id", "order_id").agg(F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


def _inc_facts_sql() -> str:
    merged = {"orders": INC_MERGED_ORDERS, **{t: _inc_child_sql(t) for t in L.FACTS[1:]}}
    return O.with_raw(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, _batch_id, order_id, count(*) AS rows FROM ({sql}) GROUP BY _batch_id, order_id"
        for t, sql in merged.items()), *ALL_RAW)


@register("resume_after_failed_orders", _inc_rows_sql())
def q_resume_failed_orders(spark, d):
    # the orders step fails on a value that does not cast, so its children are
    # skipped; the resume runs all four and ends like an uninterrupted batch
    root, _ = _full_load(spark, d)
    raw = _raw_tables(spark, d, 2)
    broken = dict(raw.frames)
    broken["orders"] = broken["orders"].withColumn("order_approved_at", F.lit("no time"))
    log = L.incremental_load(spark, L.RawTables(broken), f"{root}/curated", B2_LOAD, ops_root=f"{root}/ops")
    states = {r["table_name"]: r["status"] for r in log.collect()}
    if states["orders"] != "FAILED" or {states[t] for t in L.FACTS[1:]} != {"SKIPPED"}:
        raise _Lost(str(states))
    L.resume_incremental(spark, raw, f"{root}/curated", B2_LOAD,
                         spark.read.parquet(f"{root}/ops/pipeline_run_log"), ops_root=f"{root}/ops")
    return _curated_facts(spark, root)


@register("resume_after_lost_log", _inc_facts_sql())
def q_resume_lost_log(spark, d):
    # every table was written, but no log row survived: the resume finds the
    # live versions and changes nothing
    root, _ = _full_load(spark, d)
    raw = _raw_tables(spark, d, 2)
    L.incremental_load(spark, raw, f"{root}/curated", B2_LOAD)
    L.resume_incremental(spark, raw, f"{root}/curated", B2_LOAD,
                         spark.read.parquet(f"{root}/ops/pipeline_run_log"), ops_root=f"{root}/ops")
    return _fact_counts(spark, root)


@register("resume_after_lost_log_summary", _inc_summary_sql())
def q_resume_lost_log_summary(spark, d):
    root, _ = _full_load(spark, d)
    raw = _raw_tables(spark, d, 2)
    L.incremental_load(spark, raw, f"{root}/curated", B2_LOAD)
    log = L.resume_incremental(spark, raw, f"{root}/curated", B2_LOAD,
                               spark.read.parquet(f"{root}/ops/pipeline_run_log"), ops_root=f"{root}/ops")
    return log.select(*_LOG_COLS)


def _no_dates(df):
    return df.withColumn("order_purchase_timestamp", F.when(F.col("order_id") % 3 != 0, F.col("order_purchase_timestamp")))


_NO_DATE = ("SELECT * REPLACE (CASE WHEN order_id % 3 <> 0 THEN order_purchase_timestamp END AS order_purchase_timestamp) "
            "FROM ")


@register("upsert_null_partitions", _sql(O.merge_sql(
    _NO_DATE + f"({INC_TGT_ORDERS})",
    f"SELECT * EXCLUDE (_source_file, _batch_id) FROM ({_NO_DATE} ({O.curated_orders_sql('b2', 'raw_orders_b2')}))",
    ["order_id"], "order_status", L.MERGE_RULES["orders"][2], ORDER_OUT, C.SOURCE_LABELS["orders"], "b2"
    ).replace(", _action FROM", ", strftime(CASE WHEN _action = 'insert' THEN s_order_purchase_timestamp ELSE "
              "t_order_purchase_timestamp END, '%Y-%m') AS month FROM", 1), *ALL_RAW))
def q_upsert_null_partitions(spark, d):
    # a third of the orders have no purchase time, in the target and the source;
    # the whole second batch is merged
    root = new_run_dir(spark, "orders-null-month")
    raw1, raw2 = _raw_tables(spark, d, 1), _raw_tables(spark, d, 2)
    first = _no_dates(C.curate_orders(raw1["orders"], raw1["customers"], B1))
    V.replace(X.with_month(first, "order_purchase_timestamp"), root, "b1", ["month"])
    src = _no_dates(C.curate_orders(raw2["orders"], raw2["customers"]))
    keys, change, upd = L.MERGE_RULES["orders"]
    U.upsert_partitions(spark, root, src, keys, change, upd, B2, "month", _month,
                        source_label=C.SOURCE_LABELS["orders"])
    return no_load_ts(V.read(spark, root))


@register("partitioned_overwrite_twice", _sql(
    "SELECT seller_id, seller_state FROM raw_sellers WHERE seller_state <> 'xx'", "raw_sellers"))
def q_partitioned_overwrite(spark, d):
    path = new_run_dir(spark, "sellers-by-state")
    s = TT.raw_sellers(spark, d).select("seller_id", "seller_state")
    SK.write_full(s, path, partition_by=["seller_state"])
    SK.write_full(s.filter("seller_state <> 'xx'"), path, partition_by=["seller_state"])   # one partition fewer
    return spark.read.parquet(path).select("seller_id", F.col("seller_state").cast("string").alias("seller_state"))


@register("csv_retry_same_version", _sql(
    "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(order_item_id AS VARCHAR) AS order_item_id, "
    "CAST(0 AS BIGINT) AS rejected FROM raw_order_items", "raw_order_items"))
def q_csv_retry(spark, d):
    # the first file breaks its budget of one bad line; the corrected one is
    # loaded under the same version and leaves nothing of the first attempt
    raw = TT.raw_order_items(spark, d).select("order_id", "order_item_id")
    line = F.concat_ws(",", "order_id", "order_item_id")
    bad, good, root = (new_run_dir(spark, x) for x in ("csv-bad", "csv-good", "csv-raw"))
    raw.select(F.when(F.col("order_item_id") < 7, line).otherwise(F.concat(line, F.lit(",x"))).alias("value")) \
       .write.text(bad)
    raw.select(line.alias("value")).write.text(good)
    schema = CSV.string_schema(["order_id", "order_item_id"])
    try:
        CSV.load_raw_csv(spark, bad, schema, root, "v1", max_bad=1, header=False)
        raise _Lost("the budget did not hold")
    except CSV.BadRecordBudgetExceeded:
        pass
    m = CSV.load_raw_csv(spark, good, schema, root, "v1", max_bad=1, header=False)
    left = spark.read.schema(schema).parquet(f"{root}/v=v1").count()
    return CSV.read_raw(spark, root).withColumn("rejected", F.lit(m["rejected"] + left - m["rows"]).cast("bigint"))


# ======================================= from text files to curated tables

_RAW_COLS = {
    "orders": ["order_id", "customer_id", "order_status", *O.ORDERS_TS],
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "order_items": _ITEM_RAW_COLS, "order_reviews": _REVIEW_RAW_COLS,
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                 "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
    "category_translation": ["product_category_name", "product_category_name_english"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
}


def _text_loads(spark, d):
    """Both batches as CSV, ingested, loaded in full and incrementally, and
    checked. Returns the lake's root."""
    root = new_run_dir(spark, "text-lake")
    for batch, version in ((1, "b1"), (2, "b2")):
        landing, tables = new_run_dir(spark, "landing"), _raw_tables(spark, d, batch)
        for n in L.RAW_NAMES:
            CSV.write_csv(tables[n].select(*_RAW_COLS[n]), f"{landing}/{n}.csv", compression="gzip", rows_a_file=1_000_000)
        report = CSV.ingest_all(
            spark, landing, {f"{n}.csv": (f"raw_{n}", _RAW_COLS[n]) for n in L.RAW_NAMES}, f"{root}/raw", version,
            multiline=["raw_order_reviews"], typed_copies={"raw_orders": ["order_purchase_timestamp"]})
        states = {r["table_name"]: (r["status"], r["error_message"]) for r in report.collect()}
        if {s for s, _ in states.values()} != {"LOADED"}:
            raise _Lost(str(states))
        raw = L.raw_tables(spark, f"{root}/raw")
        load = L.full_load if batch == 1 else L.incremental_load
        log = load(spark, raw, f"{root}/curated", RunContext(batch_id=version), ops_root=f"{root}/ops")
        failed = [(r["table_name"], r["error_message"]) for r in log.collect() if r["status"] != "SUCCESS"]
        if failed:
            raise _Lost(str(failed))
    L.quality_run(spark, raw["orders"], f"{root}/curated", B2_LOAD, ops_root=f"{root}/ops",
                  catalog=TT.STATUS_CATALOG_TEST)
    return root


def _text_sql(sql: str, cols) -> str:
    ids = {"order_id", "product_id", "seller_id", "review_id"}
    return O.with_raw("SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in ids else c for c in cols)
                      + f" FROM ({sql})", *ALL_RAW)


_TEXT = {"orders": (INC_MERGED_ORDERS, C.ORDER_COLS), "order_items": (_inc_child_sql("order_items"), C.ITEM_COLS),
         "order_payments": (_inc_child_sql("order_payments"), C.PAYMENT_COLS),
         "order_reviews": (_inc_child_sql("order_reviews"), C.REVIEW_COLS),
         "products": (O.curated_products_sql("b2"), C.PRODUCT_COLS), "sellers": (O.curated_sellers_sql("b2"), C.SELLER_COLS)}


def _text_ids(sql: str) -> str:
    """Ids that the curate step passes on as they are stay text, so that ties
    among them are broken as text."""
    return sql.replace("l_partkey AS product_id, l_suppkey AS seller_id",
                       "CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id") \
              .replace("l_partkey AS product_id,\n           l_suppkey AS seller_id",
                       "CAST(l_partkey AS VARCHAR) AS product_id,\n           CAST(l_suppkey AS VARCHAR) AS seller_id")


for _t, (_q, _cols) in _TEXT.items():
    register(f"from_text_{_t}", _text_ids(_text_sql(_q, [*_cols, "_batch_id"])))(
        lambda spark, d, t=_t, cols=tuple(_cols): SK.read_current(
            spark, f"{_text_loads(spark, d)}/curated/{t}").select(*cols, "_batch_id"))


# ============================================= casts, contracts and reports

@register("cast_offsets", _sql(
    "SELECT order_id, order_purchase_timestamp - CASE order_id % 4 WHEN 0 THEN INTERVAL 2 HOUR WHEN 1 THEN INTERVAL 0 HOUR "
    "WHEN 2 THEN INTERVAL (-330) MINUTE ELSE INTERVAL 0 HOUR END AS ts FROM raw_orders", "raw_orders"))
def q_cast_offsets(spark, d):
    raw = TT.raw_orders(spark, d)
    zone = F.element_at(F.array(*[F.lit(z) for z in ("+02:00", "Z", "-05:30", "")]), (F.col("order_id") % 4 + 1).cast("int"))
    text = raw.select("order_id", F.concat(F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss"), zone).alias("ts"))
    return text.select("order_id", P.cast_timestamp(text, "ts").alias("ts"))


@register("trim_unicode", _sql("SELECT customer_id, lower(customer_unique_id) AS name FROM raw_customers", "raw_customers"))
def q_trim_unicode(spark, d):
    c = TT.raw_customers(spark, d)
    padded = F.concat(F.lit("\u00a0\t"), "customer_unique_id", F.lit("\u3000 \u2003\n"))
    return c.select("customer_id", P.norm_lower(padded).alias("name"))


def _late_load(spark, d, **options):
    root, _ = _full_load(spark, d)
    raw = _raw_tables(spark, d, 2)
    frames = dict(raw.frames, orders=TT.raw_orders_batch2_late(spark, d))
    log = L.incremental_load(spark, L.RawTables(frames), f"{root}/curated", B2_LOAD, tables=["orders"], **options)
    failed = [r["error_message"] for r in log.collect() if r["status"] != "SUCCESS"]
    if failed:
        raise _Lost(str(failed))
    return no_load_ts(SK.read_current(spark, f"{root}/curated/orders"))


def _inc_late_sql(where: str) -> str:
    body = O.merge_sql(INC_TGT_ORDERS, _late_src(where), ["order_id"], "order_status", L.MERGE_RULES["orders"][2],
                       ORDER_OUT, C.SOURCE_LABELS["orders"], "b2")
    return O.with_raw(f"SELECT * EXCLUDE (_action) FROM ({body})", *ALL_RAW, "raw_orders_b2_late")


@register("incremental_lookback", _inc_late_sql(f"order_purchase_timestamp > {INC_MARK} - INTERVAL 400 DAY"))
def q_incremental_lookback(spark, d):
    return _late_load(spark, d, lookback_days=400)


@register("incremental_late_updates", _inc_late_sql(
    f"order_purchase_timestamp > {INC_MARK} OR EXISTS (SELECT 1 FROM ({INC_TGT_ORDERS}) t "
    "WHERE t.order_id = s.order_id AND t.order_status <> s.order_status)"))
def q_incremental_late(spark, d):
    return _late_load(spark, d, late_updates=True)


_CONTRACT = {"columns": {"order_id": {"nullable": False}, "order_status": {"allowed": ["o", "f", "p"], "max_null_rate": 0.001},
                         "coupon": {"type": "string"}}}


@register("contract_checks", _sql(
    "SELECT 'contract_orders_' || rule AS check_name, CASE WHEN affected = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
    "CAST(affected AS BIGINT) AS affected_count, total AS total_count FROM (SELECT count(*) AS total, "
    "0 AS order_id__missing, count_if(order_id IS NULL) AS order_id__null, 0 AS order_status__missing, "
    "greatest(count_if(order_status IS NULL) - CAST(floor(count(*) * 0.001) AS BIGINT), 0) AS order_status__null_rate, "
    "count_if(order_status NOT IN ('o', 'f', 'p')) AS order_status__allowed, 1 AS coupon__missing FROM raw_orders_gaps) "
    "UNPIVOT (affected FOR rule IN (order_id__missing, order_id__null, order_status__missing, order_status__null_rate, "
    "order_status__allowed, coupon__missing))", "raw_orders", "raw_orders_gaps"))
def q_contract_checks(spark, d):
    return X.contract_checks(TT.raw_orders_with_gaps(spark, d), "orders", _CONTRACT, B1) \
            .select("check_name", "status", "affected_count", "total_count")


@register("freshness", _sql(
    "SELECT max(order_purchase_timestamp) AS newest, "
    "epoch(TIMESTAMP '2030-01-01' - max(order_purchase_timestamp)) / 3600.0 AS age_hours, true AS stale FROM raw_orders",
    "raw_orders"))
def q_freshness(spark, d):
    return X.freshness(TT.raw_orders(spark, d), "order_purchase_timestamp", "2030-01-01 00:00:00", 24.0)


@register("rows_for_tenant", _sql("SELECT order_id, order_item_id FROM raw_order_items WHERE seller_id = 1", "raw_order_items"))
def q_rows_for(spark, d):
    return X.rows_for(TT.raw_order_items(spark, d), "seller_id", 1).select("order_id", "order_item_id")


@register("drop_batch", _sql(f"SELECT * EXCLUDE (_action) FROM ({INC_MERGED_ORDERS}) WHERE _batch_id <> 'b2'", *ALL_RAW))
def q_drop_batch(spark, d):
    root, _ = _full_load(spark, d)
    L.incremental_load(spark, _raw_tables(spark, d, 2), f"{root}/curated", B2_LOAD, tables=["orders"])
    return no_load_ts(X.drop_batch(SK.read_current(spark, f"{root}/curated/orders"), "b2"))


@register("rejects_table", _sql(
    "SELECT 'order_items' AS table_name, 'b1' AS batch_id, 'price_missing' AS reject_reason, count(*) AS rows "
    "FROM raw_order_items WHERE price IS NULL GROUP BY ALL", "raw_order_items"))
def q_rejects_table(spark, d):
    path = new_run_dir(spark, "rejects")
    _, rej = X.split_rejects(TT.raw_order_items(spark, d), {"price_missing": F.col("price").isNull()}, B1)
    X.write_rejects(rej, "order_items", path)
    return spark.read.parquet(path).groupBy("table_name", "batch_id", "reject_reason").agg(F.count("row").alias("rows"))


@register("expired_batches", _sql(
    "SELECT CAST(order_id % 10 AS VARCHAR) AS batch_id, max(order_purchase_timestamp) AS last_run FROM raw_orders "
    "GROUP BY 1 HAVING max(order_purchase_timestamp) < TIMESTAMP '2030-01-01' - INTERVAL 90 DAY", "raw_orders"))
def q_expired(spark, d):
    log = TT.raw_orders(spark, d).select((F.col("order_id") % 10).cast("string").alias("batch_id"),
                                         F.col("order_purchase_timestamp").alias("run_timestamp"))
    return X.expired(log, "2030-01-01 00:00:00", 90)


from . import registry_versions  # noqa: E402,F401 - registers its queries
