"""Queries that return the fact tables after a load, an undo or a resume: whole rows, on tables of a few rows."""

from collections import Counter
from datetime import datetime

import pytest

import __spark_entry__ as E
from layerforge.context import new_run_dir
from layerforge.plans import curate as C
from layerforge.sources import sinks as SK
from layerforge.testing import registry

DAY = datetime(2000, 3, 1)
TABLES = {
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "N", 1)]),
    "region": ("r_regionkey int, r_name string", [(1, "R")]),
    "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(5, "Five", 1, 1.0, "SEG")]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(7, "Seven", 1, 1.0)]),
    "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
             [(3, "part", "b", "PROMO", 4, 2.0)]),
    # 40 comes again in the second batch, with another status; 41 stays; 42 is of the second batch
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
               [(40, 5, "F", 1.0, DAY, "1"), (41, 5, "F", 1.0, DAY, "1"), (42, 5, "P", 1.0, datetime(2001, 2, 1), "1")]),
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                 [(k, 3, 7, n, 1.0, 100.0 * n, 0.0, 0.5, "N", "O", DAY) for k in (40, 41, 42) for n in (1, 2)]),
    "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
               [(k, DAY, k, "card", 10.0, '{"k": 1}') for k in (40, 41, 42)]),
}
#: status of the orders, price of their second items, value of their payments
FIRST = {40: ("f", 200.0, 10.0), 41: ("f", 200.0, 10.0)}
BOTH = {40: ("r", 220.0, 11.0), 41: ("f", 200.0, 10.0), 42: ("p", 220.0, 11.0)}


@pytest.fixture(scope="module")
def tables(spark):
    root = new_run_dir(spark, "few-rows")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def check(spark, tables, name, expected):
    df = E.queries()[name](spark, tables)
    columns = {"table_name", "rows", "_batch_id", "_source_file", *C.ORDER_COLS, *C.ITEM_COLS, *C.PAYMENT_COLS, *C.REVIEW_COLS}
    assert columns <= set(df.columns)
    rows = df.collect()
    of = lambda t: {r["order_id"]: r for r in rows if r["table_name"] == t and r["order_item_id"] in (None, 2)}
    status, price, paid = of("orders"), of("order_items"), of("order_payments")
    assert {k: (status[k]["order_status"], round(price[k]["price"], 6), paid[k]["payment_value"]) for k in status} == expected
    assert all(r["rows"] == 1 for r in rows) and status[41]["customer_city"] == "five"
    # of items and payments of orders that are not loaded yet, too
    assert Counter(r["table_name"] for r in rows) == {"orders": len(expected), "order_items": 6, "order_payments": 3, "order_reviews": 3}


def test_a_row_counts_with_all_its_columns(spark):
    root = new_run_dir(spark, "facts")
    for t, rows, schema in (("orders", [(1, "a", "b1")], "order_id long, order_status string, _batch_id string"),
                            ("order_items", [(1, 1, 5.0, "b1"), (1, 1, 5.0, "b1"), (1, 1, 6.0, "b1"), (None, None, None, "b1")],
                             "order_id long, order_item_id int, price double, _batch_id string"),
                            ("order_payments", [(1, 2.0, "b1")], "order_id long, payment_value double, _batch_id string"),
                            ("order_reviews", [], "order_id long, review_score int, _batch_id string")):
        SK.write_snapshot(spark.createDataFrame(rows, schema).selectExpr("*", "current_timestamp() AS _load_timestamp"), f"{root}/curated/{t}", "b1")
    df = registry._curated_facts(spark, root)
    got = Counter(tuple(r) for r in df.select("table_name", "order_id", "order_status", "price", "payment_value", "rows").collect())
    assert got == Counter([("orders", 1, "a", None, None, 1), ("order_items", 1, None, 5.0, None, 2), ("order_items", 1, None, 6.0, None, 1),
                           ("order_items", None, None, None, None, 1), ("order_payments", 1, None, None, 2.0, 1)])
    assert "_load_timestamp" not in df.columns


def test_replay_after_undo(spark, tables):
    check(spark, tables, "replay_after_undo", BOTH)


def test_resume_after_failed_orders(spark, tables):
    check(spark, tables, "resume_after_failed_orders", BOTH)


def test_undo_batch_facts(spark, tables):
    check(spark, tables, "undo_batch_facts", FIRST)
