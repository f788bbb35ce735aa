"""DuckDB SQL for the side-by-side check: the raw adaptations of
``testing.tables`` as CTEs, and a helper to prepend them to a query.

Conventions that make both engines agree: the warehouse trim is a regex
(``'g'`` flag in DuckDB), NULL ordering is always spelled out, counts and
day differences are BIGINT.
"""

from __future__ import annotations

from ..plans import curate as C

# whitespace trim, DuckDB spelling
def trim_ws(expr: str) -> str:
    space = "[\\s\\x{0B}\\x{85}\\p{Z}]+"           # \\s alone is ASCII here
    return f"regexp_replace({expr}, '^{space}|{space}$', '', 'g')"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

CTES: dict[str, str] = {
    "raw_orders": f"""
  _ship AS (SELECT l_orderkey, min(l_shipdate) AS carrier, max(l_shipdate) AS delivered
            FROM lineitem GROUP BY l_orderkey),
  _ro_base AS (
    SELECT o.o_orderkey AS order_id,
           CAST(o.o_custkey AS VARCHAR) AS customer_id,
           CASE WHEN o.o_orderkey % 7 = 0 THEN '  ' || o.o_orderstatus || chr(9)
                ELSE o.o_orderstatus END AS order_status,
           o.o_orderdate AS order_purchase_timestamp,
           o.o_orderdate + INTERVAL 1 DAY AS order_approved_at,
           s.carrier AS order_delivered_carrier_date,
           s.delivered AS order_delivered_customer_date,
           o.o_orderdate + INTERVAL 1200 DAY AS order_estimated_delivery_date
    FROM orders o LEFT JOIN _ship s ON o.o_orderkey = s.l_orderkey),
  raw_orders AS (
    SELECT * FROM _ro_base
    UNION ALL
    SELECT order_id, customer_id, 'X' AS order_status,
           order_purchase_timestamp + INTERVAL 1 DAY, order_approved_at,
           order_delivered_carrier_date, order_delivered_customer_date,
           order_estimated_delivery_date
    FROM _ro_base WHERE order_id % 50 = 0)""",
    "raw_customers": """
  raw_customers AS (
    SELECT CASE WHEN c_nationkey = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0')
                ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
           c_name AS customer_unique_id,
           lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
           ' ' || c_name || chr(9) AS customer_city,
           lower(c_mktsegment) || ' ' AS customer_state
    FROM customer)""",
    "raw_order_items": """
  raw_order_items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
           l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
           CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS price,
           l_tax AS freight_value
    FROM lineitem)""",
    "raw_order_items_b2": """
  raw_order_items_b2 AS (
    SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
           CASE WHEN order_item_id % 2 = 0 THEN price * 1.1 ELSE price END AS price,
           freight_value
    FROM raw_order_items)""",
    "raw_order_payments": f"""
  raw_order_payments AS (
    SELECT user_id AS order_id,
           CASE WHEN {K} % 4 <> 3 THEN {K} % 4 END AS payment_sequential,
           ' ' || upper(event_type) || ' ' AS payment_type,
           CASE WHEN {K} % 5 <> 0 THEN {K} % 5 END AS payment_installments,
           value AS payment_value
    FROM events)""",
    "raw_order_payments_b2": """
  raw_order_payments_b2 AS (
    SELECT order_id, payment_sequential, payment_type, payment_installments,
           CASE WHEN payment_sequential = 1 THEN payment_value + 1.0 ELSE payment_value END
             AS payment_value
    FROM raw_order_payments)""",
    "raw_orders_gaps": """
  raw_orders_gaps AS (
    SELECT CASE WHEN order_id % 501 <> 0 THEN order_id END AS order_id, customer_id,
           CASE WHEN order_id % 97 <> 0 THEN order_status END AS order_status,
           order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
           order_delivered_customer_date, order_estimated_delivery_date
    FROM raw_orders)""",
    "raw_order_reviews": f"""
  raw_order_reviews AS (
    SELECT event_id % 4000 AS review_id, user_id AS order_id, {K} % 7 AS review_score,
           CASE WHEN {K} % 3 = 0 THEN '   ' ELSE event_type END AS review_comment_title,
           props AS review_comment_message,
           ts - INTERVAL 1 DAY AS review_creation_date,
           ts AS review_answer_timestamp
    FROM events)""",
    "raw_products": """
  _rp_base AS (
    SELECT p_partkey AS product_id, ' ' || p_type AS product_category_name,
           length(p_name) AS product_name_lenght, length(p_brand) AS product_description_lenght,
           p_size % 5 AS product_photos_qty, p_retailprice AS product_weight_g,
           p_size AS product_length_cm, p_size AS product_height_cm,
           CASE WHEN p_size % 7 <> 0 THEN p_size END AS product_width_cm
    FROM part),
  raw_products AS (
    SELECT * FROM _rp_base
    UNION ALL
    SELECT product_id, product_category_name, product_name_lenght, product_description_lenght,
           product_photos_qty + 1, product_weight_g, product_length_cm, product_height_cm,
           product_width_cm
    FROM _rp_base WHERE product_id % 100 = 0)""",
    "raw_category_translation": """
  raw_category_translation AS (
    SELECT DISTINCT p_type AS product_category_name, p_type || ' EN' AS product_category_name_english
    FROM part WHERE p_type <> 'PROMO')""",
    "raw_sellers": """
  _rs_base AS (
    SELECT s.s_suppkey AS seller_id, lpad(CAST(s.s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
           '  ' || n.n_name || ' ' AS seller_city, lower(r.r_name) AS seller_state
    FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
  raw_sellers AS (
    SELECT * FROM _rs_base
    UNION ALL
    SELECT seller_id, seller_zip_code_prefix, seller_city, 'xx' FROM _rs_base WHERE seller_id % 10 = 0)""",
    "raw_orders_b2": """
  raw_orders_b2 AS (
    SELECT * FROM raw_orders
    UNION ALL
    SELECT order_id, customer_id,
           CASE WHEN order_id % 40 = 0 THEN 'R' ELSE order_status END,
           order_purchase_timestamp + INTERVAL 2500 DAY, order_approved_at,
           order_delivered_carrier_date, order_delivered_customer_date,
           order_estimated_delivery_date
    FROM raw_orders
    WHERE order_id % 20 = 0 AND order_purchase_timestamp <= TIMESTAMP '2000-12-01 00:00:00')""",
}

CTES["raw_orders_b2_late"] = """
  raw_orders_b2_late AS (
    SELECT order_id, customer_id,
           CASE WHEN order_id % 30 = 0 THEN 'L' ELSE order_status END AS order_status,
           order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
           order_delivered_customer_date, order_estimated_delivery_date
    FROM raw_orders_b2)"""

# which raw CTEs each one needs first
DEPS = {
    "raw_order_items_b2": ["raw_order_items"],
    "raw_order_payments_b2": ["raw_order_payments"],
    "raw_orders_gaps": ["raw_orders"],
    "raw_orders_b2": ["raw_orders"],
    "raw_orders_b2_late": ["raw_orders", "raw_orders_b2"],
}

# ----------------------------------------------------------- curated (SQL)

ORDERS_TS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date"]


def clean_orders_sql(src: str = "raw_orders", where: str = "") -> str:
    tie = ", ".join(f"{c} ASC NULLS FIRST" for c in
                    ["order_status"] + ORDERS_TS[1:] + ["customer_id"])
    extra = f" AND {where}" if where else ""
    return f"""
    SELECT * EXCLUDE (_rn) FROM (
      SELECT order_id, customer_id, lower({trim_ws('order_status')}) AS order_status,
             {', '.join(f'CAST({c} AS TIMESTAMP) AS {c}' for c in ORDERS_TS)},
             ROW_NUMBER() OVER (PARTITION BY order_id
                                ORDER BY CAST(order_purchase_timestamp AS TIMESTAMP) DESC NULLS LAST,
                                         {tie}) AS _rn
      FROM (SELECT * FROM {src} WHERE order_id IS NOT NULL) q
      WHERE true{extra}
    ) WHERE _rn = 1"""


CUSTOMERS_CLEAN = f"""
    SELECT customer_id, customer_unique_id,
           CAST(customer_zip_code_prefix AS VARCHAR) AS customer_zip_code_prefix,
           lower({trim_ws('customer_city')}) AS customer_city,
           upper({trim_ws('customer_state')}) AS customer_state
    FROM raw_customers WHERE customer_id IS NOT NULL"""

#: How a curated column is stated where it is not simply copied. NULLs pass
#: through date arithmetic and comparisons by themselves.
DERIVED = {
    "days_to_delivery": "CAST(CAST(order_delivered_customer_date AS DATE) - CAST(order_purchase_timestamp AS DATE) AS BIGINT)",
    "delivered_on_time": "order_delivered_customer_date <= order_estimated_delivery_date",
    "product_volume_cm3": "product_length_cm * product_height_cm * product_width_cm",
    "product_category_name_en": "coalesce(category_en, 'unknown')",
}


def columns_sql(cols) -> str:
    return ", ".join(f"{DERIVED[c]} AS {c}" if c in DERIVED else c for c in cols)


def curated_orders_sql(batch: str = "b1", src: str = "raw_orders", where: str = "") -> str:
    return f"""
    SELECT {columns_sql(C.ORDER_COLS)}, 'raw.raw_orders' AS _source_file, '{batch}' AS _batch_id
    FROM ({clean_orders_sql(src, where)}) LEFT JOIN ({CUSTOMERS_CLEAN}) USING (customer_id)"""


def curated_items_sql(batch: str = "b1", src: str = "raw_order_items") -> str:
    return f"""
    SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
           coalesce(_p, 0.0) AS price, freight_value, coalesce(_p, 0.0) + freight_value AS total_item_value,
           'raw.raw_order_items' AS _source_file, '{batch}' AS _batch_id
    FROM (
      SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id,
             CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
             CAST(price AS DOUBLE) AS _p,
             coalesce(CAST(freight_value AS DOUBLE), 0.0) AS freight_value
      FROM {src} WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, order_item_id
        ORDER BY _p DESC NULLS LAST, product_id ASC NULLS FIRST, seller_id ASC NULLS FIRST,
                 shipping_limit_date ASC NULLS FIRST, freight_value ASC NULLS FIRST) = 1"""


def curated_payments_sql(batch: str = "b1", src: str = "raw_order_payments") -> str:
    return f"""
    SELECT order_id, payment_sequential, payment_type, payment_installments,
           coalesce(_v, 0.0) AS payment_value,
           'raw.raw_order_payments' AS _source_file, '{batch}' AS _batch_id
    FROM (
      SELECT order_id, CAST(payment_sequential AS BIGINT) AS payment_sequential,
             lower({trim_ws('payment_type')}) AS payment_type,
             coalesce(CAST(payment_installments AS BIGINT), 0) AS payment_installments,
             CAST(payment_value AS DOUBLE) AS _v
      FROM {src} WHERE order_id IS NOT NULL)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, payment_sequential
        ORDER BY _v DESC NULLS LAST, payment_type ASC NULLS FIRST,
                 payment_installments ASC NULLS FIRST) = 1"""


def typed_reviews_sql(src: str = "raw_order_reviews") -> str:
    return f"""
      SELECT review_id, order_id, CAST(review_score AS BIGINT) AS review_score,
             nullif({trim_ws('review_comment_title')}, '') AS review_comment_title,
             nullif({trim_ws('review_comment_message')}, '') AS review_comment_message,
             CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
             CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp
      FROM {src}
      WHERE review_id IS NOT NULL AND order_id IS NOT NULL
        AND CAST(review_score AS BIGINT) BETWEEN 1 AND 5"""


REVIEW_ORDER = """ORDER BY review_answer_timestamp DESC NULLS LAST, order_id ASC NULLS FIRST,
                 review_score ASC NULLS FIRST, review_comment_title ASC NULLS FIRST,
                 review_comment_message ASC NULLS FIRST, review_creation_date ASC NULLS FIRST"""


def curated_reviews_sql(batch: str = "b1", src: str = "raw_order_reviews") -> str:
    return f"""
    SELECT *, 'raw.raw_order_reviews' AS _source_file, '{batch}' AS _batch_id
    FROM ({typed_reviews_sql(src)})
    QUALIFY ROW_NUMBER() OVER (PARTITION BY review_id {REVIEW_ORDER}) = 1"""


PRODUCT_TIE = ", ".join(f"{c} ASC NULLS FIRST" for c in [
    "product_category_name_pt", "product_name_length", "product_description_length",
    "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
    "product_width_cm"])


def curated_products_sql(batch: str = "b1") -> str:
    return f"""
    SELECT {columns_sql(C.PRODUCT_COLS)}, 'raw.raw_products' AS _source_file, '{batch}' AS _batch_id
    FROM (
      SELECT product_id, lower({trim_ws('product_category_name')}) AS product_category_name_pt,
             CAST(product_name_lenght AS BIGINT) AS product_name_length,
             CAST(product_description_lenght AS BIGINT) AS product_description_length,
             CAST(product_photos_qty AS BIGINT) AS product_photos_qty,
             CAST(product_weight_g AS DOUBLE) AS product_weight_g,
             CAST(product_length_cm AS DOUBLE) AS product_length_cm,
             CAST(product_height_cm AS DOUBLE) AS product_height_cm,
             CAST(product_width_cm AS DOUBLE) AS product_width_cm
      FROM raw_products WHERE product_id IS NOT NULL
      QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY {PRODUCT_TIE}) = 1) p
    LEFT JOIN (
      SELECT lower({trim_ws('product_category_name')}) AS category_pt,
             lower({trim_ws('product_category_name_english')}) AS category_en
      FROM raw_category_translation) t
    ON p.product_category_name_pt = t.category_pt"""


def curated_sellers_sql(batch: str = "b1") -> str:
    return f"""
    SELECT *, 'raw.raw_sellers' AS _source_file, '{batch}' AS _batch_id FROM (
      SELECT seller_id, CAST(seller_zip_code_prefix AS VARCHAR) AS seller_zip_code_prefix,
             lower({trim_ws('seller_city')}) AS seller_city,
             upper({trim_ws('seller_state')}) AS seller_state
      FROM raw_sellers WHERE seller_id IS NOT NULL)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix ASC NULLS FIRST,
        seller_city ASC NULLS FIRST, seller_state ASC NULLS FIRST) = 1"""


def with_raw(body: str, *names: str, extra: str = "") -> str:
    """``WITH <raw CTEs> [, extra] <body>``; ``body`` starts with SELECT."""
    order: list[str] = []
    for n in names:
        for d in DEPS.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    parts = [CTES[n].strip() for n in order]
    if extra:
        parts.append(extra.strip())
    return "WITH " + ",\n  ".join(parts) + "\n" + body


CUTOFF = "TIMESTAMP '2000-12-01 00:00:00'"


def target_orders_sql() -> str:
    return f"SELECT * FROM ({curated_orders_sql('b1')}) WHERE order_purchase_timestamp <= {CUTOFF}"


def merge_sql(tgt: str, src: str, keys, change: str, update_cols, cols, label: str,
              batch: str) -> str:
    """FULL OUTER JOIN + CASE form of the conditional upsert. ``cols``: all
    target columns except the load time."""
    biz = [c for c in cols if c not in ("_source_file", "_batch_id")]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sel = ", ".join([f"t.{c} AS t_{c}" for c in cols] + [f"s.{c} AS s_{c}" for c in biz])
    out = []
    for c in cols:
        if c == "_source_file":
            out.append(f"CASE WHEN _action = 'insert' THEN '{label}' ELSE t__source_file END AS _source_file")
        elif c == "_batch_id":
            out.append(f"CASE WHEN _action <> 'keep' THEN '{batch}' ELSE t__batch_id END AS _batch_id")
        elif c in update_cols:
            out.append(f"CASE WHEN _action = 'keep' THEN t_{c} ELSE s_{c} END AS {c}")
        else:
            out.append(f"CASE WHEN _action = 'insert' THEN s_{c} ELSE t_{c} END AS {c}")
    return f"""
    SELECT {', '.join(out)}, _action FROM (
      SELECT *, CASE WHEN _t AND _s AND coalesce(t_{change} <> s_{change}, false) THEN 'update'
                     WHEN _t AND _s THEN 'keep'
                     WHEN _s THEN 'insert' ELSE 'keep' END AS _action
      FROM (SELECT {sel}, t._t, s._s
            FROM (SELECT *, true AS _t FROM ({tgt})) t
            FULL OUTER JOIN (SELECT *, true AS _s FROM ({src})) s ON {on}))"""
