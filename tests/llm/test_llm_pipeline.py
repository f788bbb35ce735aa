"""The pipeline stage by stage against brute force, and the registration."""

import re

import corpus_pipeline as C
import __spark_entry__ as E
from layerforge.llm import packing, pieces, queries
from layerforge.llm import quality_rules as Q
from tests.llm.conftest import SF
from tests.llm.test_llm_dedup import slow_components, slow_fingerprint, slow_substrings

ORDER = ["quality rules", "exact dedup", "simhash near-dedup", "substring dedup", "packing"]


def test_registered():
    assert [n for n, _ in C.STAGES] == ORDER
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(E.oracle_sql())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(C.STAGES)
    # an extra copy of everything with other white space, so that every stage has work
    docs = docs.unionByName(docs.selectExpr("doc_id + 1000 AS doc_id", "concat(text, '\n\n') AS text", "lang", "source", "n_chars"))
    docs = docs.unionByName(docs.filter("doc_id % 3 = 0").selectExpr(
        "doc_id + 5000 AS doc_id", "concat('other start here ', text) AS text", "lang", "source", "n_chars"))
    rows = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    kept = C.materialise(stages["quality rules"](spark, docs, SF), "t")
    assert kept.columns == docs.columns
    want = {r["doc_id"] for r in Q.verdicts(docs).collect() if r["kept"]}
    assert set(rows(kept)) == want and 0 < len(want) < docs.count()

    exact = C.materialise(stages["exact dedup"](spark, kept, SF), "t")
    best = {}
    for i, t in rows(kept).items():
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (1, 0)), (-len(t), i))
    assert set(rows(exact)) == {i for _, i in best.values()}

    near = C.materialise(stages["simhash near-dedup"](spark, exact, SF), "t")
    comp = slow_components([(i, slow_fingerprint(t)) for i, t in rows(exact).items()])
    assert set(rows(near)) == set(comp.values())

    cut = C.materialise(stages["substring dedup"](spark, near, SF), "t")
    want = slow_substrings(list(rows(near).items()), 50)
    got = rows(cut)
    for (i, t), (_, gone, words) in want.items():
        assert got[i] == (" ".join(words) if gone else t)
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect() if want[(r["doc_id"], rows(near)[r["doc_id"]])][1])

    packed = stages["packing"](spark, cut, SF).collect()
    enc = pieces.encoding(pieces.vocabulary_path(packing.VOCABULARY))
    total = {}
    for r in packed:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    assert total == {i: len(enc.encode_ordinary(t)) for i, t in got.items() if t}


def test_run_returns_the_last_stage(spark):
    out = C.run(spark, SF)
    assert out.columns == ["doc_id", "segment", "start", "n_tokens", "bucket_tokens", "batch", "slot"]
    assert out.count() > 0
