"""Curated-table builders (C1-C6): raw frame(s) in, curated frame out.

Each builder is one declarative plan: NOT-NULL key filters and casts are
projected first (so the filters reach the parquet scan), then the keep-one
dedup, then enrichment joins, derived columns and lineage. Builders never
write; the loads in ``plans.loads`` decide where the result goes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.columns import (blank_to_null, cast_or_zero, cast_strict, cast_timestamp,
                                 days_between_dates, default_unknown, in_range,
                                 norm_lower, norm_upper, on_time, product_if_all,
                                 sum_of)
from ..operators.relational import enrich, keep_one
from ..sources.csv import TYPED

LINEAGE_COLS = ["_source_file", "_load_timestamp", "_batch_id"]

# Source labels written to ``_source_file`` per curated table.
SOURCE_LABELS = {
    "orders": "raw.raw_orders",
    "order_items": "raw.raw_order_items",
    "order_payments": "raw.raw_order_payments",
    "order_reviews": "raw.raw_order_reviews",
    "products": "raw.raw_products",
    "sellers": "raw.raw_sellers",
}

ORDER_COLS = [
    "order_id", "customer_id", "customer_unique_id", "customer_zip_code_prefix",
    "customer_city", "customer_state", "order_status", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "days_to_delivery", "delivered_on_time",
]
ITEM_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
             "price", "freight_value", "total_item_value"]
PAYMENT_COLS = ["order_id", "payment_sequential", "payment_type", "payment_installments",
                "payment_value"]
REVIEW_COLS = ["review_id", "order_id", "review_score", "review_comment_title",
               "review_comment_message", "review_creation_date", "review_answer_timestamp"]
PRODUCT_COLS = ["product_id", "product_category_name_pt", "product_category_name_en",
                "product_name_length", "product_description_length", "product_photos_qty",
                "product_weight_g", "product_length_cm", "product_height_cm",
                "product_width_cm", "product_volume_cm3"]
SELLER_COLS = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]

_TS_ORDER = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date"]


def add_lineage(df: DataFrame, source: str, ctx: RunContext) -> DataFrame:
    """Traceability columns. ``current_timestamp()`` is evaluated once
    per query, so every row of one write carries the same load time."""
    return df.withColumns({
        "_source_file": F.lit(source),
        "_load_timestamp": F.current_timestamp(),
        "_batch_id": F.lit(ctx.batch_id),
    })


def _finish(df: DataFrame, cols: Sequence[str], table: str, ctx: RunContext | None,
            source: str | None) -> DataFrame:
    out = df.select(*cols)
    if ctx is None:
        return out
    return add_lineage(out, source or SOURCE_LABELS[table], ctx)


# ------------------------------------------------------------------- orders

def clean_orders(raw_orders: DataFrame, tie_breakers: Sequence[str] | None = None,
                 newer_than=None) -> DataFrame:
    """Typed, normalised, one row per order_id (latest purchase wins).

    ``newer_than`` applies the high-water filter *before* the dedup: the
    dedup orders by the same purchase timestamp descending, so every key
    with a row above the mark keeps the same winner, and the filter can be
    pushed into the scan (Catalyst does not push it through the window). On
    a raw text layer the typed copy of the purchase time that the ingest
    writes (``TYPED`` + name, see ``sources.csv``) takes the filter.
    """
    typed = TYPED + "order_purchase_timestamp"
    if newer_than is not None and typed in raw_orders.columns:
        raw_orders = raw_orders.filter(F.col(typed) > newer_than)
    o = (raw_orders.filter(F.col("order_id").isNotNull())
         .select("order_id", "customer_id",
                 norm_lower("order_status").alias("order_status"),
                 *[cast_timestamp(raw_orders, c).alias(c) for c in _TS_ORDER]))
    if newer_than is not None:
        o = o.filter(F.col("order_purchase_timestamp") > newer_than)
    return keep_one(o, "order_id", ["order_purchase_timestamp"],
                    tie_breakers=tie_breakers or ["order_status"] + _TS_ORDER[1:] + ["customer_id"])


def clean_customers(raw_customers: DataFrame) -> DataFrame:
    return (raw_customers.filter(F.col("customer_id").isNotNull())
            .select("customer_id", "customer_unique_id",
                    cast_strict("customer_zip_code_prefix", "string").alias("customer_zip_code_prefix"),
                    norm_lower("customer_city").alias("customer_city"),
                    norm_upper("customer_state").alias("customer_state")))


def derive_order_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "days_to_delivery": days_between_dates("order_delivered_customer_date",
                                               "order_purchase_timestamp"),
        "delivered_on_time": on_time("order_delivered_customer_date",
                                     "order_estimated_delivery_date"),
    })


def orders_from_clean(clean: DataFrame, raw_customers: DataFrame,
                      lookup_unique: str = "allow") -> DataFrame:
    j = enrich(clean, clean_customers(raw_customers), ["customer_id"],
               lookup_unique=lookup_unique, lookup_keys=["customer_id"])
    return derive_order_metrics(j).select(*ORDER_COLS)


def curate_orders(raw_orders: DataFrame, raw_customers: DataFrame,
                  ctx: RunContext | None = None, source: str | None = None,
                  lookup_unique: str = "allow") -> DataFrame:
    """Orders, deduped by latest purchase, enriched with the customer."""
    out = orders_from_clean(clean_orders(raw_orders), raw_customers, lookup_unique)
    return _finish(out, ORDER_COLS, "orders", ctx, source)


# -------------------------------------------------------------- order items

def typed_items(raw_items: DataFrame) -> DataFrame:
    return (raw_items
            .filter(F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull())
            .select("order_id",
                    cast_strict("order_item_id", "int64").alias("order_item_id"),
                    "product_id", "seller_id",
                    cast_timestamp(raw_items, "shipping_limit_date").alias("shipping_limit_date"),
                    cast_strict("price", "float64").alias("_price_raw"),
                    cast_or_zero("freight_value", "float64").alias("freight_value")))


def dedup_items(typed: DataFrame) -> DataFrame:
    """Highest raw price wins (NULL price last), then the other columns."""
    d = keep_one(typed, ["order_id", "order_item_id"], ["_price_raw"],
                 tie_breakers=["product_id", "seller_id", "shipping_limit_date", "freight_value"])
    return (d.withColumn("price", F.coalesce(F.col("_price_raw"), F.lit(0.0)))
             .withColumn("total_item_value", sum_of("price", "freight_value"))
             .select(*ITEM_COLS))


def curate_order_items(raw_items: DataFrame, ctx: RunContext | None = None,
                       source: str | None = None) -> DataFrame:
    """Items keyed by (order_id, order_item_id), price/freight default 0."""
    return _finish(dedup_items(typed_items(raw_items)), ITEM_COLS, "order_items", ctx, source)


# ----------------------------------------------------------- order payments

def typed_payments(raw_payments: DataFrame) -> DataFrame:
    return (raw_payments.filter(F.col("order_id").isNotNull())
            .select("order_id",
                    cast_strict("payment_sequential", "int64").alias("payment_sequential"),
                    norm_lower("payment_type").alias("payment_type"),
                    cast_or_zero("payment_installments", "int64").alias("payment_installments"),
                    cast_strict("payment_value", "float64").alias("_value_raw")))


def dedup_payments(typed: DataFrame) -> DataFrame:
    d = keep_one(typed, ["order_id", "payment_sequential"], ["_value_raw"],
                 tie_breakers=["payment_type", "payment_installments"])
    return (d.withColumn("payment_value", F.coalesce(F.col("_value_raw"), F.lit(0.0)))
             .select(*PAYMENT_COLS))


def curate_order_payments(raw_payments: DataFrame, ctx: RunContext | None = None,
                          source: str | None = None) -> DataFrame:
    """Payments keyed by (order_id, payment_sequential)."""
    return _finish(dedup_payments(typed_payments(raw_payments)), PAYMENT_COLS,
                   "order_payments", ctx, source)


# ------------------------------------------------------------ order reviews

def typed_reviews(raw_reviews: DataFrame) -> DataFrame:
    """Range filter on the cast score happens before the dedup, so the
    latest *valid* answer wins."""
    return (raw_reviews
            .filter(F.col("review_id").isNotNull() & F.col("order_id").isNotNull())
            .select("review_id", "order_id",
                    cast_strict("review_score", "int64").alias("review_score"),
                    blank_to_null("review_comment_title").alias("review_comment_title"),
                    blank_to_null("review_comment_message").alias("review_comment_message"),
                    cast_timestamp(raw_reviews, "review_creation_date").alias("review_creation_date"),
                    cast_timestamp(raw_reviews, "review_answer_timestamp").alias("review_answer_timestamp"))
            .filter(in_range("review_score", 1, 5)))


def dedup_reviews(typed: DataFrame) -> DataFrame:
    return keep_one(typed, "review_id", ["review_answer_timestamp"],
                    tie_breakers=["order_id", "review_score", "review_comment_title",
                                  "review_comment_message", "review_creation_date"]
                    ).select(*REVIEW_COLS)


def curate_order_reviews(raw_reviews: DataFrame, ctx: RunContext | None = None,
                         source: str | None = None) -> DataFrame:
    """C4: reviews keyed by review_id, latest valid answer."""
    return _finish(dedup_reviews(typed_reviews(raw_reviews)), REVIEW_COLS,
                   "order_reviews", ctx, source)


# ------------------------------------------------------------------ products

_PRODUCT_CASTS = {
    "product_name_length": ("product_name_lenght", "int64"),
    "product_description_length": ("product_description_lenght", "int64"),
    "product_photos_qty": ("product_photos_qty", "int64"),
    "product_weight_g": ("product_weight_g", "float64"),
    "product_length_cm": ("product_length_cm", "float64"),
    "product_height_cm": ("product_height_cm", "float64"),
    "product_width_cm": ("product_width_cm", "float64"),
}


def curate_products(raw_products: DataFrame, raw_translation: DataFrame,
                    ctx: RunContext | None = None, source: str | None = None,
                    lookup_unique: str = "allow") -> DataFrame:
    """Products with the translated category name and volume. NULL
    dimensions stay NULL (absence is meaningful)."""
    p = (raw_products.filter(F.col("product_id").isNotNull())
         .select("product_id",
                 norm_lower("product_category_name").alias("product_category_name_pt"),
                 *[cast_strict(src, t).alias(dst) for dst, (src, t) in _PRODUCT_CASTS.items()]))
    p = keep_one(p, "product_id", [])
    t = raw_translation.select(
        norm_lower("product_category_name").alias("category_pt"),
        norm_lower("product_category_name_english").alias("category_en"))
    j = enrich(p, t, F.col("product_category_name_pt") == F.col("category_pt"),
               lookup_unique=lookup_unique, lookup_keys=["category_pt"])
    out = j.withColumns({
        "product_category_name_en": default_unknown("category_en"),
        "product_volume_cm3": product_if_all("product_length_cm", "product_height_cm",
                                             "product_width_cm"),
    })
    return _finish(out, PRODUCT_COLS, "products", ctx, source)


# ------------------------------------------------------------------- sellers

def curate_sellers(raw_sellers: DataFrame, ctx: RunContext | None = None,
                   source: str | None = None) -> DataFrame:
    """Sellers with normalised casing; zip kept as text."""
    s = (raw_sellers.filter(F.col("seller_id").isNotNull())
         .select("seller_id",
                 cast_strict("seller_zip_code_prefix", "string").alias("seller_zip_code_prefix"),
                 norm_lower("seller_city").alias("seller_city"),
                 norm_upper("seller_state").alias("seller_state")))
    return _finish(keep_one(s, "seller_id", []), SELLER_COLS, "sellers", ctx, source)
