"""Exact, SimHash and substring dedup against brute force."""

import hashlib
import re

import duckdb
import numpy as np
import pytest

from layerforge.llm import exact_dedup as E
from layerforge.llm import simhash as S
from layerforge.llm import substring_dedup as R
from tests.llm.conftest import SF, awkward_rows


# ------------------------------------------------------------------- exact

def test_exact_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = sorted(map(tuple, E.op4_exact_dedup(spark, SF).collect()))
    assert got == sorted(con.execute(E.OP4_SQL).fetchall())


def test_exact_awkward_rows(awkward):
    rows = E.once(awkward).collect()
    assert len(rows) == len(awkward_rows())
    groups = {}
    for i, t, *_ in awkward_rows():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    by_digest = {hashlib.sha256(k.encode()).digest(): v for k, v in groups.items()}
    for r in rows:
        members = by_digest[bytes(r["digest"])]
        longest = max(len(t) for _, t in members)
        ids = [i for i, t in members if len(t) == longest and i is not None]
        assert r["keep_id"] == (min(ids) if ids else None) and r["group_size"] == len(members)
    kept = [bytes(r["digest"]) for r in rows if r["kept"]]
    assert len(kept) == len(set(kept)) == len(groups)          # one row of each text stays


def test_exact_dedup_returns_rows_unchanged(awkward, no_rows):
    out = E.dedup(awkward)
    assert out.columns == awkward.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in awkward_rows()})
    assert E.dedup(no_rows).collect() == [] and E.once(no_rows).collect() == []


def test_index_keeps_what_came_first(spark):
    index = E.fresh_index(spark)
    try:
        docs = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, text string")
        first = {r["doc_id"]: r["kept"] for r in index.ingest(docs((5, "a b"), (6, "c"))).collect()}
        second = {r["doc_id"]: (r["kept"], r["keep_id"], r["known"])
                  for r in index.ingest(docs((1, "ab"), (2, "d"), (3, "d "))).collect()}
        third = index.ingest(docs((9, "d"), (8, "c"))).collect()
        assert first == {5: True, 6: True}
        assert second == {1: (False, 5, True), 2: (False, 3, False), 3: (True, 3, False)}
        assert not any(r["kept"] for r in third)
        assert index.read().count() == 3
        plan = index.read().select("digest").hint("merge").join(index.read().select("digest"), "digest")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan                          # bucketed: joined without a shuffle
    finally:
        index.drop()


def test_retried_batch_gets_the_same_decisions(spark):
    """A batch that was registered but whose caller was lost is ingested again,
    also when a later batch has come in between."""
    index = E.fresh_index(spark)
    docs = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, text string")
    told = lambda df: sorted((r["doc_id"], r["keep_id"], r["group_size"], r["known"], r["kept"]) for r in df.collect())
    try:
        index.ingest(docs((7, "old"), (8, None)), "b0")
        b1 = docs((1, "a b"), (2, "ab"), (3, "c"), (4, "o l d"), (5, ""))
        first = told(index.ingest(b1, "b1"))
        assert first == [(1, 1, 2, False, True), (2, 1, 2, False, False), (3, 3, 1, False, True),
                         (4, 7, 1, True, False), (5, 8, 1, True, False)]
        assert told(index.ingest(b1, "b1")) == first
        assert told(index.ingest(docs((9, "c"), (10, "new")), "b2")) == [(9, 3, 1, True, False), (10, 10, 1, False, True)]
        assert told(index.ingest(b1, "b1")) == first
        assert sorted(r["doc_id"] for r in E.dedup(b1, index, "b1").collect()) == [1, 3]
        digests = [bytes(r["digest"]) for r in index.read().collect()]
        assert len(digests) == len(set(digests)) == 5
        assert told(index.ingest(b1)) == [(i, k, n, True, False) for i, k, n, *_ in first]      # no name: not a retry
        assert told(index.ingest(b1.limit(0), "b1")) == [] and index.read().count() == 5
    finally:
        index.drop()


def test_exact_plan_is_native(spark):
    plan = E.once(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ----------------------------------------------------------------- simhash

def slow_fingerprint(text, n=4):
    import xxhash
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k:k + n]).encode(), 42) for k in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows, max_bits=4):
    fp = [f for _, f in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if bin(fp[i] ^ fp[j]).count("1") <= max_bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    out = {}
    for (i, f), x in zip(rows, label):
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == x and rows[k][0] is not None]
        out[(i, f)] = min(ids) if ids else None
    return out


def check_groups(df, rows):
    want = slow_components([(i, slow_fingerprint(t)) for i, t in rows])
    got = {(r[S.KEY_ID], r["fp"] % 2 ** 64): r["component_id"] for r in S.groups(df).collect()}
    assert got == want


def test_simhash_awkward_rows(awkward, no_rows):
    check_groups(awkward, [(i, t) for i, t, *_ in awkward_rows()])
    assert S.groups(no_rows).collect() == [] and S.dedup(no_rows).collect() == []


def test_simhash_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = slow_components([(i, slow_fingerprint(t)) for i, t in rows])
    got = {(r["doc_id"], int(r["fingerprint"], 16)): r["component_id"] for r in S.op2_simhash_near_dedup(spark, SF).collect()}
    assert got == want


def test_simhash_keeps_one_of_each_group(awkward):
    out = S.dedup(awkward)
    assert out.columns == awkward.columns
    comps = {(r[S.KEY_ID], r[S.KEY_HASH]): r["root"] for r in S.groups(awkward).collect()}
    assert len({(r["doc_id"], r["text"]) for r in out.collect()}) == len(set(comps.values()))


@pytest.mark.parametrize("segments,block", [(2, 4096), (3, 4), (4, 8), (5, 4096)])
def test_links_are_complete_for_any_segments_and_hot_values(spark, segments, block):
    """All pairs within the distance are joined, also when a table value is hot
    and its entries are split over tasks."""
    rng = np.random.default_rng(segments)
    centre = rng.integers(0, 2 ** 63, 6, dtype=np.uint64)
    fps = {int(c) for c in centre}
    for c in centre:
        for _ in range(40):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            fps.add(int(c) ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2 ** 64 if f >= 2 ** 63 else f,) for f in fps], "fp long")
    got = {r["a"] % 2 ** 64: r["b"] for r in S.components(S.links(df, 4, segments, block)).collect()}
    label = {f: k for k, f in enumerate(fps)}
    changed = True
    while changed:
        changed = False
        for f in fps:
            for g in fps:
                if (f ^ g).bit_count() <= 4 and label[g] < label[f]:
                    label[f], changed = label[g], True
    same = lambda d: {frozenset(f for f in fps if d[f] == x) for x in set(d.values())}
    assert same(label) == same({f: got.get(f, f - 2 ** 64 if f >= 2 ** 63 else f) for f in fps})


def test_forest_keeps_components():
    a, b = np.array([5, 9, 7, 1], np.uint64), np.array([7, 7, 2, 3], np.uint64)
    assert set(zip(*map(lambda x: x.tolist(), S.forest(a, b)))) == {(5, 2), (7, 2), (9, 2), (3, 1)}


# --------------------------------------------------------------- substring

def slow_substrings(rows, window):
    """(doc_id, text) -> (n_words, n_removed, kept words)."""
    first = {}
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    late = float("inf")
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, late), late if i is None else i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < (late if i is None else i):
                gone[k:k + window] = [True] * window
        out[(i, t)] = (len(w), sum(gone), [x for x, g in zip(w, gone) if not g])
    return out


@pytest.mark.parametrize("window,gram", [(50, 8), (10, 3)])
def test_substring_awkward_rows(awkward, window, gram):
    rows = [(i, t) for i, t, *_ in awkward_rows()]
    want = slow_substrings(rows, window)
    out = R.dedup(awkward, window, gram).collect()
    assert len(out) == len(rows) and R.dedup(awkward).columns == awkward.columns
    kept = sorted(" ".join(want[k][2]) for k in rows)
    assert sorted(" ".join(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in out) == kept
    for r in out:
        assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) and r["kept"] == "clash"


def test_substring_overlapping_passages(spark):
    """Passages that repeat at odd offsets, runs that only join at a factor
    boundary, and one passage that many documents share."""
    import random
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("xyz")
    text = lambda n: [word() for _ in range(n)]
    common, p, q = text(14), text(25), text(18)
    rows = [(1, p + text(5)), (2, text(3) + q + text(2)), (3, p[10:] + q[:12] + text(6)), (4, p[:20] + q),
            (5, ["w"] * 60), (6, ["w"] * 25 + text(9)), (7, text(2) + ["w"] * 11)]
    rows += [(k, text(rng.randint(0, 9)) + common + text(rng.randint(0, 9))) for k in range(10, 60)]
    rows = [(i, " ".join(w)) for i, w in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = slow_substrings(rows, 10)
    done = R.cleaned(R.with_marks(df, 10, 3), 10, False)
    got = {r[R.KEY_ID]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in done.collect()}
    assert got == {i: (n, g, hashlib.sha256(" ".join(w).encode()).hexdigest()) for (i, _), (n, g, w) in want.items()}


def test_substring_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = slow_substrings(rows, 50)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in R.op3_substring_dedup(spark, SF).collect()}
    assert got == {i: (n, g, hashlib.sha256(" ".join(w).encode()).hexdigest()) for (i, _), (n, g, w) in want.items()}


def test_substring_empty(no_rows):
    assert R.dedup(no_rows).collect() == []
