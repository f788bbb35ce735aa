"""Adaptations of the supplied TPC-H-like tables into the raw inputs the
loads expect (orders, customers, items, payments, reviews, products,
category translation, sellers).

Every raw frame is derived from *whole* supplied tables; rows are only
re-shaped, dirtied (padding, casing, NULLs, re-issued duplicates) or added,
never dropped, so the work of each query grows with the tables. The same
definitions are written in DuckDB SQL in ``testing.oracle`` for the
side-by-side check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test adaptations.
BATCH_1 = "b1"
BATCH_2 = "b2"
CUTOFF = "2000-12-01 00:00:00"   # purchases up to here form the first load
REISSUE_DAYS = 2500              # re-issued orders move this far forward
ESTIMATE_DAYS = 1200             # estimated delivery = purchase + this
STATUS_CATALOG_TEST = ["p", "f"]  # catalog used for the domain check on test data


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days(col, n: int):
    return col + F.expr(f"INTERVAL {n} DAYS")


def _with_copies(df: DataFrame, cond, changes: dict) -> DataFrame:
    """Rows matching ``cond`` appear twice; the second copy has ``changes``.
    One scan (an ``explode`` of a one- or two-element array), instead of a
    union that would read and compute the input twice."""
    copy = F.explode(F.when(cond, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    d = df.withColumn("_copy", copy)
    return d.withColumns({c: F.when(F.col("_copy") == 1, v).otherwise(F.col(c))
                          for c, v in changes.items()}).drop("_copy")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per order plus re-issued duplicates (every 50th order
    again, one day later and with status 'X'); status padded with blanks and
    a tab on every 7th order; delivery dates from the order's line items."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            "o_orderdate")
    ship = (read(spark, sf_dir, "lineitem").groupBy("l_orderkey")
            .agg(F.min("l_shipdate").alias("carrier"), F.max("l_shipdate").alias("delivered")))
    b = o.join(ship, o.o_orderkey == ship.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(F.col("o_orderkey") % 7 == 0,
               F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit("\t")))
         .otherwise(F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        _days(F.col("o_orderdate"), 1).alias("order_approved_at"),
        F.col("carrier").alias("order_delivered_carrier_date"),
        F.col("delivered").alias("order_delivered_customer_date"),
        _days(F.col("o_orderdate"), ESTIMATE_DAYS).alias("order_estimated_delivery_date"))
    return _with_copies(b, F.col("order_id") % 50 == 0, {
        "order_status": F.lit("X"),
        "order_purchase_timestamp": _days(F.col("order_purchase_timestamp"), 1)})


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; ids of nation 0 were written zero-padded by a legacy
    system, so their orders find no customer (lookup misses)."""
    c = read(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    return c.select(
        F.when(F.col("c_nationkey") == 0, F.lpad(key, 8, "0")).otherwise(key).alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("\t")).alias("customer_city"),
        F.concat(F.lower(F.col("c_mktsegment")), F.lit(" ")).alias("customer_state"))


def raw_order_items(spark: SparkSession, sf_dir: str, reprice: bool = False) -> DataFrame:
    """line items as order items (natural duplicate keys); price missing
    on line 7. ``reprice`` is the second batch: even lines cost 10 % more."""
    li = read(spark, sf_dir, "lineitem")
    price = F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double")) \
             .otherwise(F.col("l_extendedprice"))
    if reprice:
        price = F.when(F.col("l_linenumber") % 2 == 0, price * 1.1).otherwise(price)
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        F.col("l_tax").alias("freight_value"))


def _k():
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def raw_order_payments(spark: SparkSession, sf_dir: str, reprice: bool = False) -> DataFrame:
    """events as payments of order ``user_id``. ``reprice`` is the second
    batch: first installments (sequential 1) are one unit dearer."""
    e = read(spark, sf_dir, "events")
    k = _k()
    seq = F.when(k % 4 != 3, k % 4)
    value = F.col("value")
    if reprice:
        value = F.when(seq == 1, value + 1.0).otherwise(value)
    return e.select(
        F.col("user_id").alias("order_id"),
        seq.alias("payment_sequential"),
        F.concat(F.lit(" "), F.upper(F.col("event_type")), F.lit(" ")).alias("payment_type"),
        F.when(k % 5 != 0, k % 5).alias("payment_installments"),
        value.alias("payment_value"))


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as reviews; ids repeat every 4000 events, scores 0..6 so
    some fall outside 1..5, blank titles on every third ``k``."""
    e = read(spark, sf_dir, "events")
    k = _k()
    return e.select(
        (F.col("event_id") % 4000).alias("review_id"),
        F.col("user_id").alias("order_id"),
        (k % 7).alias("review_score"),
        F.when(k % 3 == 0, F.lit("   ")).otherwise(F.col("event_type")).alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        _days(F.col("ts"), -1).alias("review_creation_date"),
        F.col("ts").alias("review_answer_timestamp"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """parts as products, every 100th part listed twice (second copy
    with one more photo); width missing when the size is a multiple of 7."""
    p = read(spark, sf_dir, "part")
    base = p.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit(" "), F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        (F.col("p_size") % 5).alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        F.col("p_size").alias("product_length_cm"),
        F.col("p_size").alias("product_height_cm"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("product_width_cm"))
    return _with_copies(base, F.col("product_id") % 100 == 0,
                        {"product_photos_qty": F.col("product_photos_qty") + 1})


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category names with an English label; PROMO has none (lookup miss)."""
    p = read(spark, sf_dir, "part")
    return (p.select("p_type").filter(F.col("p_type") != "PROMO").distinct()
            .select(F.col("p_type").alias("product_category_name"),
                    F.concat(F.col("p_type"), F.lit(" EN")).alias("product_category_name_english")))


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """suppliers as sellers with nation/region as city/state; every
    10th supplier listed twice with a different state."""
    s = read(spark, sf_dir, "supplier")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    base = (s.join(n, s.s_nationkey == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
             .select(F.col("s_suppkey").alias("seller_id"),
                     F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
                     F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")).alias("seller_city"),
                     F.lower(F.col("r_name")).alias("seller_state")))
    return _with_copies(base, F.col("seller_id") % 10 == 0, {"seller_state": F.lit("xx")})


def raw_orders_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 source: every raw order again, plus re-issues of every 20th order
    of the first load, moved ``REISSUE_DAYS`` later; every 40th re-issue
    changes its status to 'R'."""
    ro = raw_orders(spark, sf_dir)
    cond = (F.col("order_id") % 20 == 0) & (F.col("order_purchase_timestamp") <= cutoff())
    return _with_copies(ro, cond, {
        "order_purchase_timestamp": _days(F.col("order_purchase_timestamp"), REISSUE_DAYS),
        "order_status": F.when(F.col("order_id") % 40 == 0, F.lit("R"))
                         .otherwise(F.col("order_status"))})


def raw_orders_batch2_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 source with late status changes: every 30th order also changes its
    status to 'L' without a new purchase time (a change the default delta,
    which keys on the purchase time, never sees)."""
    b2 = raw_orders_batch2(spark, sf_dir)
    return b2.withColumn("order_status", F.when(F.col("order_id") % 30 == 0, F.lit("L"))
                         .otherwise(F.col("order_status")))


def raw_orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8/Q1: raw orders with missing values: status NULL on every 97th
    order, order id NULL on every 501st."""
    ro = raw_orders(spark, sf_dir)
    return ro.select(
        F.when(F.col("order_id") % 501 != 0, F.col("order_id")).alias("order_id"),
        "customer_id",
        F.when(F.col("order_id") % 97 != 0, F.col("order_status")).alias("order_status"),
        *[c for c in ro.columns if c not in ("order_id", "customer_id", "order_status")])


def cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")
