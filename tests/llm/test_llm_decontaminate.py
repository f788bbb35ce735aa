"""Benchmark decontamination against SQL and plain loops."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from layerforge.llm import decontaminate as D
from layerforge.llm.common import KEY_ID
from tests.conftest import plan_text
from tests.llm.conftest import CLASHING, SF, awkward_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def slow(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - window, 0) + 1) if w else []:
            windows.setdefault(tuple(w[s:s + window]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        out.append((i, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r[KEY_ID], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in df.collect()), key=str)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = sorted(map(tuple, D.op13_decontaminate(spark, SF).collect()))
    assert got == sorted(con.execute(D.OP13_SQL).fetchall()) and any(r[-1] for r in got)


BASE = awkward_rows()[0][1].split()
ITEMS = [(1, " ".join(BASE[5:40])), (2, " ".join(BASE[20:30]).upper() + "!"), (2, " ".join(BASE[90:104])), (3, "one"), (4, "de de de"),
         (5, " ".join(["de"] * 12)), (6, None), (7, ""), (8, "?! ..."), (None, "ä ß 日本"), (None, "Another, TEXT; under"),
         (9, "another text under"), (10, " ".join(BASE[20:30])), (11, "never seen words of an item that is in no document at all"),
         (12, "x" * 200_000)]


@pytest.fixture(scope="module")
def items(spark):
    df = spark.createDataFrame(ITEMS, "item_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in [*CLASHING, "w", "n", "window", "item", "hashes"]})


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 26])
@pytest.mark.parametrize("window,shingle", [(10, 5), (3, 3), (7, 1)])
def test_awkward_rows(awkward, items, broadcast_bytes, window, shingle):
    """Both ways of the join, for items of 1 word to 35, at every shingle length."""
    want = slow([(i, t) for i, t, *_ in awkward_rows()], ITEMS, window)
    docs = awkward.withColumns({c: F.lit("clash") for c in ("w", "n", "place", "h", "size", "window")})
    assert rows(D.contamination(docs, items, window, shingle, broadcast_bytes)) == want
    assert any(n for _, _, n, _ in want)


def test_ids_sort_as_strings(spark):
    items = spark.createDataFrame([(k, "same words here") for k in (9, 10, 100, 2)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the same words here.")], "doc_id long, text string")
    assert D.contamination(docs, items).first()["items"] == ["10", "100", "2", "9"]


def test_empty_tables(awkward, no_rows, items):
    assert D.contamination(no_rows, items).collect() == []
    assert {r["n_hit"] for r in D.contamination(awkward, items.limit(0)).collect()} == {0}
    clean = D.drop_contaminated(awkward, items.limit(0))
    assert clean.columns == awkward.columns and clean.count() == awkward.count()


def test_drop_contaminated(awkward, items):
    want = [i for i, _, n, _ in slow([(i, t) for i, t, *_ in awkward_rows()], ITEMS) if not n]
    out = D.drop_contaminated(awkward, items)
    assert out.columns == awkward.columns and sorted(map(str, (r["doc_id"] for r in out.collect()))) == sorted(map(str, want))


def test_a_passage_that_most_documents_share(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("w"), F.col("id").cast("string"),
                                                                            F.when(F.col("id") % 3 > 0, passage)).alias("text"))
    items = spark.createDataFrame([(1, passage), (2, " ".join(f"p{k}" for k in range(3, 18)))], "item_id long, text string")
    got = D.contamination(docs, items).groupBy("n_hit", F.size("items").alias("m")).count().collect()
    assert sorted(map(tuple, got)) == [(0, 0, 134), (30, 2, 266)]


def test_plan_is_native_and_splits_texts_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = plan_text(D.document_shingles(docs, [5]))
    assert "Python" not in plan and "Arrow" not in plan and plan.count("regexp_extract_all") == 1
    digest = hashlib.sha256(b"").hexdigest()
    clean = D.op13_decontaminate(spark, SF).filter("NOT contaminated").select("items_sha256").distinct().collect()
    assert [r[0] for r in clean] == [digest]
