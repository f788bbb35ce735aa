from datetime import datetime

import pytest

from layerforge.functions import columns as P


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_trim_all_whitespace(spark):
    got = one(spark, [("  Ab\t",), ("\n x \r",), (None,)], "s string", P.norm_lower("s"))
    assert got == ["ab", "x", None]
    assert one(spark, [(" sp ",)], "s string", P.norm_upper("s")) == ["SP"]


def test_blank_to_null(spark):
    got = one(spark, [("",), ("   ",), ("\t\n",), (None,), (" a ",)], "s string", P.blank_to_null("s"))
    assert got == [None, None, None, None, "a"]


def test_cast_or_zero_and_strict(spark):
    df = spark.createDataFrame([("1",), (None,), ("2.5",)], "s string")
    assert [r[0] for r in df.select(P.cast_or_zero("s", "float64")).collect()] == [1.0, 0.0, 2.5]
    ints = spark.createDataFrame([("1",), (None,)], "s string")
    assert [r[0] for r in ints.select(P.cast_or_zero("s", "int64")).collect()] == [1, 0]
    bad = spark.createDataFrame([("x1",)], "s string").select(P.cast_strict("s", "int64"))
    with pytest.raises(Exception):
        bad.collect()


def test_days_between_calendar_dates(spark):
    rows = [(datetime(2020, 1, 1, 23, 59, 59), datetime(2020, 1, 2, 0, 0, 1)),
            (datetime(2020, 1, 5), datetime(2020, 1, 3)),
            (datetime(2020, 1, 5), None)]
    df = spark.createDataFrame(rows, "start timestamp_ntz, end timestamp_ntz")
    assert [r[0] for r in df.select(P.days_between_dates("end", "start")).collect()] == [1, -2, None]


def test_on_time_three_valued(spark):
    t = datetime(2020, 1, 1)
    rows = [(t, t), (t, datetime(2019, 1, 1)), (None, t), (t, None)]
    df = spark.createDataFrame(rows, "d timestamp_ntz, e timestamp_ntz")
    assert [r[0] for r in df.select(P.on_time("d", "e")).collect()] == [True, False, None, None]


def test_in_range_and_domain_keep_null_unknown(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "v int")
    assert [r[0] for r in df.select(P.in_range("v", 1, 5)).collect()] == [False, True, True, False, None]
    s = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    assert [r[0] for r in s.select(P.not_in_domain("s", ["a"])).collect()] == [False, True, None]


def test_changed_null_semantics(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), (None, "a"), ("a", None)], "t string, s string")
    assert [r[0] for r in df.select(P.changed("t", "s")).collect()] == [True, False, None, None]
    assert [r[0] for r in df.select(P.changed("t", "s", null_safe=True)).collect()] == [True, False, True, True]


def test_product_if_all(spark):
    df = spark.createDataFrame([(2.0, 3.0, 4.0), (2.0, None, 4.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(P.product_if_all("a", "b", "c")).collect()] == [24.0, None]
