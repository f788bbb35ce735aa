"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from layerforge.testing import registry

SF = os.environ.get("LF_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, "nan" if isinstance(v, float) and math.isnan(v) else f"{round(float(v), 6):.6f}")
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (4, str(v))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.ORACLES) == set(registry.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    assert canon(df.columns, srows) == canon([d[0] for d in cur.description], drows)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    dtypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE ({E.oracle_sql()[name]})").fetchall()}
    assert stypes == dtypes


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "order_id" in df.columns
