"""One view, two readers."""

import pytest

from layerforge.plans import views as W


@pytest.fixture
def secured(spark):
    spark.createDataFrame([(1, "sp", "ana@x"), (2, "rj", "bo@x"), (3, None, "cy@x"), (4, "mg", None), (5, "sp", None)],
                          "id long, state string, mail string").createOrReplaceTempView("lf_people")
    spark.createDataFrame([("ana", "sp", True, "k1"), ("ana", "sp", False, "k1"), ("ana", "rj", False, "k1"), ("ben", "rj", True, "k2"),
                           ("ben", "mg", None, "k2"), ("me", "sp", True, "k3")], W.ENTITLEMENTS).createOrReplaceTempView("lf_rights")
    spark.sql("DECLARE OR REPLACE VARIABLE lf_reader STRING DEFAULT 'nobody'")

    def read(reader, kind="hash"):
        W.create_view(spark, "lf_secured", "lf_people", "lf_rights", "state", {"mail": kind}, "lf_reader", temporary=True)
        spark.sql(f"SET VARIABLE lf_reader = '{reader}'")
        return sorted(map(tuple, spark.table("lf_secured").collect()))
    return read


def test_rows_and_masks_differ_by_reader(secured):
    import hashlib
    digest = lambda k, v: hashlib.sha256(f"{k}:{v}".encode()).hexdigest()
    assert secured("ana") == [(1, "sp", "ana@x"), (2, "rj", digest("k1", "bo@x")), (5, "sp", None)]
    assert secured("ben") == [(2, "rj", "bo@x"), (4, "mg", None)]
    assert secured("ana", "null") == [(1, "sp", "ana@x"), (2, "rj", None), (5, "sp", None)]
    assert secured("nobody") == []


def test_the_default_reader_is_the_session_s_user(spark, secured):
    user = spark.sql("SELECT current_user()").first()[0]
    assert "current_user()" in W.view_sql(spark, "lf_people", "lf_rights", "state", {})
    W.create_view(spark, "lf_mine", "lf_people", "lf_rights", "state", {}, temporary=True)
    assert spark.table("lf_mine").count() == (2 if user == "me" else 0)


def test_refuses_what_it_cannot_mask(spark, secured):
    for masks in ({"mail": "rot13"}, {"state": "null"}):
        with pytest.raises(ValueError):
            W.view_sql(spark, "lf_people", "lf_rights", "state", masks)


def test_a_permanent_view_of_catalog_tables(spark):
    spark.sql("CREATE TABLE lf_t USING parquet AS SELECT id, CAST(id % 2 AS STRING) AS tenant FROM range(6)")
    spark.sql("CREATE TABLE lf_e USING parquet AS SELECT current_user() AS reader, '1' AS tenant, true AS clear, 'k' AS mask_key")
    try:
        W.create_view(spark, "lf_v", "lf_t", "lf_e", "tenant", {"id": "null"})
        assert sorted(r["id"] for r in spark.table("lf_v").collect()) == [1, 3, 5]
    finally:
        for kind, n in (("VIEW", "lf_v"), ("TABLE", "lf_t"), ("TABLE", "lf_e")):
            spark.sql(f"DROP {kind} IF EXISTS {n}")
