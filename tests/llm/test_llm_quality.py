"""Quality rules: base counts against plain Python, and the robust estimate."""

import re
from collections import Counter

import numpy as np

from layerforge.llm import quality_rules as Q
from tests.llm.conftest import SF, awkward_rows

WORD = r"[^\x20\x09-\x0D]+"


def slow_counts(text):
    text = text or ""
    w = re.findall(WORD, text)
    windows = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    hit = set()
    for k in range(len(w) - 2):
        if windows[tuple(w[k:k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        want = {slow_counts(t) for t in texts[r["doc_id"]]}
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got in want
        assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert not (r["base_failed"] and r["kept"])


def test_counts_of_awkward_rows(awkward, no_rows):
    texts = {}
    for i, t, *_ in awkward_rows():
        texts.setdefault(i, []).append(t)
    rows = Q.verdicts(awkward).collect()
    assert len(rows) == len(awkward_rows())
    for r in rows:
        assert slow_counts_of(r) in {slow_counts(t) for t in texts[r["doc_id"]]}
    assert Q.verdicts(no_rows).collect() == [] and Q.keep_good(no_rows).collect() == []
    assert Q.keep_good(awkward).columns == awkward.columns


def slow_counts_of(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]


def test_counts_and_labels_of_the_table(spark):
    texts = {r["doc_id"]: [r["text"]] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op10_quality_rules(spark, SF).collect()
    check(rows, texts)
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(quality[r["doc_id"]], r["kept"], r["base_failed"]) for r in rows if r["doc_id"] in quality]
    assert not any(kept for q, kept, _ in judged if q == 0)                    # junk goes
    assert all(kept for q, kept, failed in judged if q == 1 and not failed)    # clean documents stay


def test_edges_of_counts():
    for t in ["", "a", "a a a", "a a a a", "a b c a b c", "x\nx\n \n\nx", "#*$%&|<> é é", "a\x0bb\x0cc\x1cd"]:
        assert Q.count_text(t)[:5] == slow_counts(t)


def test_estimate_resists_junk(spark):
    """The estimate of a group with a quarter of far outliers equals that of
    its clean part, and a group of any size is estimated in bounded rows."""
    rng = np.random.default_rng(0)
    clean = rng.normal([1.6, 0.1, 0.05, 0.1], [0.3, 0.6, 0.4, 0.4], (3000, 4))
    junk = rng.normal([2.6, 6.0, 0.9, 0.9], 0.05, (900, 4))
    rows = [("g", *map(float, x)) for x in np.vstack([clean, junk])]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"{x} double" for x in Q.VECTOR))
    vectors = df.selectExpr("*", "false AS base_failed", "g AS g2", "'1' AS g1", "'0' AS g0")
    found = {r["g"]: r for r in Q.estimates(vectors).collect()}["g"]
    assert found["n"] == 3900
    assert np.allclose(found["mean"], clean.mean(0), atol=0.08)
    floors = np.diag([f * f for f in Q.FLOORS.values()])
    want = np.cov(clean.T) + floors
    got = np.linalg.inv(np.array(found["inverse"]).reshape(4, 4))
    assert np.all(np.abs(np.diag(got) / np.diag(want) - 1) < 0.45)
    dev = junk - np.array(found["mean"])
    d2 = np.einsum("ij,jk,ik->i", dev, np.array(found["inverse"]).reshape(4, 4), dev)
    assert d2.min() > Q.chi2_quantile(1 - 1e-5, 4)


def test_step_against_direct_computation(spark):
    """One concentration step on few rows, against numpy on the same subset."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, 4))
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "g string, " + ", ".join(f"{c} double" for c in Q.VECTOR))
    start = Q.start_estimates(df)
    s = start.first()
    dev = x - np.array(s["mean"])
    d2 = np.einsum("ij,jk,ik->i", dev, np.array(s["inverse"]).reshape(4, 4), dev)
    bins = np.clip(np.floor(16 * np.log2(d2 + 1e-9)) + 480, 0, Q.BINS - 1)
    last = np.sort(bins)[int(np.ceil(0.75 * 400)) - 1]
    part = x[bins <= last]
    got = Q.concentrate(df, start, 0.75).first()
    assert np.allclose(got["mean"], part.mean(0))
    scatter = Q.consistency(0.75) * np.cov(part.T, bias=True) + np.diag([f * f for f in Q.FLOORS.values()])
    assert np.allclose(np.linalg.inv(np.array(got["inverse"]).reshape(4, 4)), scatter)


def test_chi_square():
    assert abs(Q.chi2_cdf(5.991464547, 2) - 0.95) < 1e-9 and abs(Q.chi2_quantile(0.95, 4) - 9.487729037) < 1e-6


def test_moderate_repetition_is_rejected(spark):
    """Repetition counts in clean groups, below what the base rules reject:
    copied lines together with repeated words, and repeated words alone."""
    rng = np.random.default_rng(8)

    def fresh(n):
        return " ".join("".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 8))) for _ in range(n))
    clean = ["\n".join(fresh(12) for _ in range(20)) for _ in range(300)]
    one_line = fresh(13)
    clean += [f"{one_line}\n{fresh(36)}\n{one_line}"] * 3                        # one line of three repeated
    lines = ["\n".join([fresh(14) + "\nread more here now\nread more here now\nread more here now" for _ in range(5)])
             for _ in range(10)]
    words = [" ".join(f"some stock phrase found all over pages {fresh(8)}" for _ in range(35)) for _ in range(10)]
    texts = clean + lines + words
    df = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    rows = {r["doc_id"]: r for r in Q.verdicts(df).collect()}
    planted = [rows[k] for k in range(len(clean), len(texts))]
    assert not any(r["base_failed"] for r in planted)
    assert [k for k in range(len(clean)) if not rows[k]["kept"]] == []
    assert [r["doc_id"] for r in planted if r["kept"]] == []


def slow_estimate(x, support=0.75, steps=4):
    """Centre and scatter of the densest share of ``x``, plainly."""
    floors = np.diag([f * f for f in Q.FLOORS.values()])
    bins = np.floor(128 * x)
    at = np.ceil(np.array([0.25, 0.5, 0.75]) * len(x)).astype(int) - 1
    quartiles = (np.sort(bins, axis=0)[at] + 0.5) / 128
    mean, scatter = quartiles[1], np.diag(((quartiles[2] - quartiles[0]) / 1.349) ** 2)
    for _ in range(steps):
        dev = x - mean
        d2 = np.einsum("ij,jk,ik->i", dev, np.linalg.inv(scatter + floors), dev)
        b = np.clip(np.floor(16 * np.log2(d2 + 1e-9)) + 480, 0, Q.BINS - 1)
        near = x[b <= np.sort(b)[int(np.ceil(support * len(x))) - 1]]
        mean, scatter = near.mean(0), Q.consistency(support) * np.atleast_2d(np.cov(near.T, bias=True))
    return mean, scatter


def slow_kept(rows):
    """doc_id -> (kept, squared distance) of (doc_id, text, lang, source)."""
    floors = np.diag([f * f for f in Q.FLOORS.values()])
    vectors = {}
    for i, text, lang, source in rows:
        n, chars, symbols, dup, repeat = slow_counts(text)
        if n >= 50 and 100 * repeat <= 50 * n:
            lines = len([x for x in text.split("\n") if re.search(WORD, x)])
            vectors[i] = (lang, source), np.array([
                np.log(max(chars, 1) / n), np.log1p(symbols / n / 0.02),
                np.arcsin(np.sqrt(dup / (lines + Q.PRIOR_LINES))), np.arcsin(np.sqrt(repeat / (n + Q.PRIOR_WORDS)))])
    member = lambda test: np.array([v for g, v in vectors.values() if test(g)])
    found = {}
    for g in {g for g, _ in vectors.values()}:
        m, v = slow_estimate(member(lambda _: True))
        for part in (member(lambda o: o[0] == g[0]), member(lambda o: o == g)):
            w = len(part) / (len(part) + Q.PRIOR_DOCS)
            mean, scatter = slow_estimate(part)
            m, v = w * mean + (1 - w) * m, w * scatter + (1 - w) * v
        found[g] = m, np.linalg.inv(v + floors)
    out = {i: (False, None) for i, *_ in rows}
    for i, (g, v) in vectors.items():
        d2 = (v - found[g][0]) @ found[g][1] @ (v - found[g][0])
        out[i] = bool(d2 <= Q.chi2_quantile(1 - 1e-5, Q.DIM)), d2
    return out


def test_verdict_against_brute_force(spark):
    """Groups of 1, 20, 200 and 2,000 documents, null languages and sources."""
    rng = np.random.default_rng(12)
    rows = []
    for lang, source, n, mean in [("en", "a", 2000, 5), ("en", "b", 200, 6), ("en", "c", 20, 5), ("de", "a", 20, 8),
                                  ("de", None, 1, 8), (None, "a", 40, 4), (None, None, 3, 4)]:
        for k in range(n):
            words = ["".join(rng.choice(list("abcdefghijkl#"), max(1, int(rng.normal(mean, 1.5))), p=[0.083] * 12 + [0.004]))
                     for _ in range(int(rng.integers(40, 90)))]
            if k % 9 == 4:
                words[10:20] = ["$$%|"] * 10                                # symbols and repeats
            rows.append((len(rows), " ".join(words), lang, source))
    rows += [(len(rows), None, "fr", "x"), (len(rows) + 1, "", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: (r["kept"], r["distance2"]) for r in Q.verdicts(df).collect() if not r["base_failed"]}
    want = {i: x for i, x in slow_kept(rows).items() if x[1] is not None}
    assert set(got) == set(want) and {k for k, _ in want.values()} == {True, False}
    for i, (kept, d2) in want.items():
        assert got[i][0] == kept and np.isclose(got[i][1], d2, rtol=1e-6)


def test_group_size_moves_the_estimate_smoothly(spark):
    """One more document moves a group's weight by little at any size, and a
    small group of its own kind is drawn to its language, not ignored."""
    schema = "g string, n long, mean array<double>, scatter array<double>, inverse array<double>"
    eye = np.diag([0.04] * 4).reshape(-1).tolist()
    rows = [("0", 10_000, [0.0] * 4, eye, eye), ('1{"lang":"en"}', 1_000_000_000, [1.0] * 4, eye, eye)]
    sizes = [1, 20, 199, 200, 201, 2000]
    rows += [(f'2{{"lang":"en","source":"{n}"}}', n, [2.0] * 4, eye, eye) for n in sizes]
    wider = spark.createDataFrame([(g, rows[1][0], "0") for g, *_ in rows[2:]], "g2 string, g1 string, g0 string")
    drawn = Q.drawn(spark.createDataFrame(rows, schema), wider)
    assert not re.search("NestedLoop|Cartesian", drawn._jdf.queryExecution().executedPlan().toString())
    found = {r["g2"]: r["mean"][0] for r in drawn.collect()}
    centre = [found[f'2{{"lang":"en","source":"{n}"}}'] for n in sizes]
    assert np.allclose(centre, [1 + n / (n + Q.PRIOR_DOCS) for n in sizes], atol=1e-6)
    assert abs(centre[3] - centre[2]) < 0.002 and abs(centre[4] - centre[3]) < 0.002
