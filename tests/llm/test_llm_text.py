"""BPE, token counts, packing, language id, chat formatting and LM scores."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from layerforge.llm import bpe, chat_format, language_id, lm_score, packing, pieces, token_counts
from tests.llm.conftest import CLASHING, SF, awkward_rows


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(pieces.vocabulary_path(bpe.VOCABULARY))


# --------------------------------------------------------------------- bpe

def test_bpe_equals_the_library(library):
    rng = random.Random(1)
    part = ["a", "b", "aa", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "᠎", "​", "'s", "'re",
            "'", "'l", "1", "²", "é", "ß", "́", "日", "<|endoftext|>", "<|endof", "😀", "!", "Ⅷ", "\r\n", "\x0b", " ",
            "\U00019e83", "೜"]
    texts = ["".join(rng.choice(part) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x24FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x1FFFF)]))
                      for _ in range(20)) for _ in range(4000)]
    texts += ["a" * 3000, "ab" * 500 + " " * 100, "", "aaaa " * 50]
    v = bpe.Vocabulary(pieces.vocabulary_path(bpe.VOCABULARY))
    for text, ids in zip(texts, bpe.encode_texts(texts, v)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, repr(text)
        assert bpe.decode(ids, v) == library.decode(want, skip_special_tokens=False) == text


def test_decode_replaces_broken_bytes(library):
    v = bpe.Vocabulary(pieces.vocabulary_path(bpe.VOCABULARY))
    ids = bpe.np.array(library.encode("日本é", add_special_tokens=False).ids[:-1])
    for cut in (ids, ids[1:], ids[::-1]):
        assert bpe.decode(cut, v) == library.decode(cut.tolist(), skip_special_tokens=False)


def test_bpe_rows(awkward, no_rows, library):
    rows = bpe.round_trip(awkward).collect()
    want = []
    for i, t, *_ in awkward_rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = [(r[bpe.KEY_ID], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert bpe.round_trip(no_rows).collect() == []
    back = bpe.decoded(bpe.encode(awkward)).collect()
    assert sorted(r["text"] for r in back) == sorted(t or "" for _, t, *_ in awkward_rows())


def test_bpe_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in bpe.op8_bpe(spark, SF).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


# ------------------------------------------------------------ token counts

def plain_count(text):
    return len(pieces.encoding(pieces.vocabulary_path(token_counts.VOCABULARY)).encode_ordinary(text))


def test_edits_on_one_tree():
    rng = random.Random(3)
    part = ["a", "the", "be", " ", "  ", "\n", "'s", "'", "r", "e", "12", ".", "é", " of", " and", "日", "\t", " x", " y"]
    text_of = lambda n: "".join(rng.choice(part) for _ in range(rng.randint(0, n)))
    count = pieces.counts(pieces.vocabulary_path(token_counts.VOCABULARY))
    for _ in range(150):
        text = text_of(rng.choice([3, 60, 800]))
        tree = token_counts.build_tree(text, count)
        assert tree.total() == plain_count(text)
        for _ in range(6):
            at, length = rng.randint(-2, len(text) + 3), rng.choice([0, 1, 3, 50, 400])
            insert = rng.choice(["", text_of(3), text_of(20), text_of(600), text_of(4000)])
            lo = min(max(at, 0), len(text))
            want = text[:lo] + insert + text[min(lo + length, len(text)):]
            tree, text, _ = token_counts.edit_tree(tree, text, at, length, insert, count)
            assert text == want and tree.total() == plain_count(text) and int(tree.chars[1]) == len(text)


def test_an_edit_encodes_a_bounded_region():
    count = pieces.counts(pieces.vocabulary_path(token_counts.VOCABULARY))
    text = "some plain words in a row " * 4000
    tree = token_counts.build_tree(text, count)
    tree, text, encoded = token_counts.edit_tree(tree, text, 50_000, 3, "new text", count)
    assert encoded < 400 and tree.total() == plain_count(text)


def test_trees_of_rows(spark, awkward, no_rows):
    trees = token_counts.build(awkward)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in token_counts.totals(trees).collect())
    assert got == sorted((i is None, i or 0, plain_count(t or "")) for i, t, *_ in awkward_rows())
    log = spark.createDataFrame([(0, 1, 3, 4, "zz"), (0, 2, 0, 0, "start "), (0, 3, None, None, None), (30, 1, 0, 5, "made"),
                                 (39, 1, 2, 100, " <|endoftext|>"), (999, 1, 0, 0, "x"), (None, 1, 0, 0, "y")],
                                "doc_id long, seq long, start int, length int, insert string")
    for per_round in (1, 1000):
        done = {r[token_counts.KEY_ID]: r for r in token_counts.apply_log(trees, log, per_round=per_round).collect()}
        texts = dict((i, t or "") for i, t, *_ in awkward_rows())
        want = {0: "start " + texts[0][:3] + "zz" + texts[0][7:], 30: "made", 39: texts[39][:2] + " <|endoftext|>"}
        for i, text in want.items():
            assert done[i]["text"] == text and done[i]["tokens"][1] == plain_count(text)
        assert done[1]["text"] == texts[1] and 999 not in done
    assert token_counts.apply_log(token_counts.build(no_rows), log).collect() == []
    assert token_counts.apply_log(trees, log.limit(0)).count() == len(awkward_rows())


def test_token_query(spark):
    trees = token_counts.build(spark.read.parquet(f"{SF}/documents.parquet"))
    edited = token_counts.apply_edits(trees.withColumn("edits", token_counts.derived_edits(F.col("text"), F.col(token_counts.KEY_ID))))
    want = {r[token_counts.KEY_ID]: plain_count(r["text"]) for r in edited.collect()}
    rows = token_counts.op7_token_counts(spark, SF).collect()
    assert {r["doc_id"]: r["n_after"] for r in rows} == want and len(rows) == len(want)


# ----------------------------------------------------------------- packing

def test_boundaries_are_optimal():
    rng = random.Random(5)
    for _ in range(200):
        h = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}
        k, lengths = rng.randint(1, 5), sorted(h)
        pad = lambda bounds: sum(h[x] * (min(b for b in bounds if b >= x) - x) for x in lengths)
        best = min(pad(c) for n in range(1, k + 1) for c in itertools.combinations(lengths, min(n, len(lengths)))
                   if c[-1] == lengths[-1])
        bounds, cost = packing.best_boundaries(h, k)
        assert cost == best == pad(bounds) and len(bounds) <= k
    assert packing.best_boundaries({}, 4) == ([], 0)


@pytest.mark.parametrize("cell", [3, 4096])
def test_packing_awkward_rows(awkward, no_rows, cell):
    rows = packing.pack(awkward, max_tokens=128, buckets=4, budget=512, cell=cell).collect()
    path = pieces.vocabulary_path(packing.VOCABULARY)
    want = sorted(len(pieces.encoding(path).encode_ordinary(t)) for _, t, *_ in awkward_rows() if t)
    spans = {}
    for r in rows:
        spans.setdefault((r[packing.KEY_ID], r[packing.KEY_HASH], r["segment"]), []).append(r)
        assert r["start"] == r["segment"] * 128 and 0 < r["n_tokens"] <= r["bucket_tokens"] <= 128
    assert sum(r["n_tokens"] for r in rows) == sum(want)
    assert len(spans[(20, spans and next(k[1] for k in spans if k[0] == 20), 0)]) == 3        # repeated rows
    batches = {}
    for r in rows:
        batches.setdefault((r["bucket_tokens"], r["batch"]), []).append(r["slot"])
    short = {}
    for (b, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= 512 // b
        short[b] = short.get(b, 0) + (len(slots) < 512 // b)
    assert max(short.values()) <= 1 and len(short) <= 4
    assert packing.pack(no_rows).collect() == []


# ------------------------------------------------------------- language id

def slow_phrases(text, refs):
    t, n = language_id.normal(text), 0
    for at in range(0, len(t), language_id.BLOCK):
        block, i = t[at:at + language_id.BLOCK], 0
        while i < len(block):
            k = 0
            while i + k < len(block) and any(block[i:i + k + 1] in r for r in refs):
                k += 1
            i += max(k, 1)
            n += 1
    return n


def test_phrases_equal_brute_force():
    rng = random.Random(2)
    samples = {"a": ["abab cab abc", "zza bab"], "b": ["xyx yab", "yyy zzx"]}
    model = language_id.Model(samples)
    texts = ["".join(rng.choice("abcxyzq ") for _ in range(rng.randint(1, 700))) for _ in range(150)]
    texts = [t for t in texts if language_id.normal(t)]
    want = [[slow_phrases(t, [language_id.normal(s) for s in samples[k]]) for k in model.languages] for t in texts]
    assert model.phrases([language_id.normal(t) for t in texts]).tolist() == want


def test_numbers_are_no_letters(spark):
    import sys
    import unicodedata
    every = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) != "Cs"]
    assert all((language_id.normal(c) == "") == (not any(x.isalpha() for x in c.lower())) for c in every)
    docs = spark.createDataFrame(enumerate(["½ ²", "Ⅷ", "٣ 1/2 _", "Ⅷ das ½ ist"]), "doc_id long, text string")
    rows = language_id.predict(docs, {"de": ["das ist"], "en": ["this"]}).collect()
    assert [(r["lang_pred"], r["score"] > 0) for r in rows] == [("und", False)] * 3 + [("de", True)]


def test_language_awkward_rows(awkward, no_rows):
    learn = awkward.select(*language_id.doc_key(), F.col("lang"), "text")
    samples = language_id.labelled_samples(learn)
    assert set(samples) == {"en", "de"}
    rows = language_id.predict(awkward, samples).collect()
    assert len(rows) == len(awkward_rows())
    for r in rows:
        assert 0 <= r["score"] <= 1
    none = sum(not any(c.isalpha() for c in t or "") for _, t, *_ in awkward_rows())
    assert sum(r["lang_pred"] == "und" and r["score"] == 0 for r in rows) == none
    assert language_id.predict(no_rows, samples).collect() == [] and language_id.labelled_samples(learn.limit(0)) == {}
    assert {r["lang_pred"] for r in language_id.predict(awkward, {}).collect()} == {"und"}


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = language_id.op9_language_id(spark, SF).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [lang[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]
    assert sum(held) / len(held) > 0.95


# --------------------------------------------------------------------- chat

def test_chat_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    out = chat_format.op5_chat_format(spark, SF)
    cur = con.execute(chat_format.OP5_SQL)
    assert out.columns == [d[0] for d in cur.description]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(cur.fetchall(), key=str)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def test_chat_awkward_turns(spark):
    rng = random.Random(7)
    turns = [(k, t, rng.choice(["ann", "bob", "cy", "system", None, "<|x"]), rng.choice(["hi", "", None, "a <|end|> b", "é" * 9]))
             for k in (1, 2, None) for t in range(40)]
    turns += [(3, 0, "ann", "same")] * 6 + [(3, None, "bob", "first"), (4, 0, "system", "only"), (5, 0, None, "nobody")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(7)
    df = df.withColumns({c: F.lit("clash") for c in [*CLASHING, "ordinal", "row", "task", "assistant", "spans"]})
    got = {(r["conv_id"], r["part"], r["assistant"]): r for r in chat_format.rotate(df, max_turns=16).collect()}
    want = {}
    order = lambda t: tuple((x is not None, x or (0 if k == 1 else "")) for k, x in enumerate(t))
    for conv in {t[0] for t in turns}:
        mine = sorted((t for t in turns if t[0] == conv), key=order)
        for p in range(0, len(mine), 16):
            part = mine[p:p + 16]
            for me in {t[2] for t in part} - {"system", None}:
                text, spans = "", []
                for _, _, role, body in part:
                    plain = lambda s: (s or "").replace("<|", "< |")
                    text += {None: "<|user|>", "system": "<|system|>", me: "<|assistant|>"}.get(
                        role, f"<|user name={plain(role)}|>") + "\n"
                    at = len(text)
                    text += plain(body) + "\n<|end|>\n"
                    if role == me:
                        spans.append((at, len(text)))
                want[(conv, p // 16, me)] = (text, spans, len(part))
    assert set(got) == set(want)
    for k, (text, spans, n) in want.items():
        assert got[k]["rendered"] == text and [tuple(s) for s in got[k]["spans"]] == spans
        assert got[k]["n_turns"] == n and got[k]["n_own"] == len(spans)
    assert chat_format.rotate(df.limit(0)).collect() == []


def test_chat_query_gives_everyone_the_whole_dialogue(spark, tmp_path):
    """Long conversations: who is silent in a part has a row for it, and system
    turns are at the head of every part after them."""
    rows = [(c, 0, "system", "rules") for c in (1, None)]
    rows += [(c, t, "ann" if t == 10 else ["bob", "cy"][t % 2], f"text {t}") for c in (1, None) for t in range(1, 300)]
    rows += [(1, 200, "system", "late"), (1, 201, "system", "rules"), (2, 0, "ann", "short"), (2, 1, None, "x"),
             (3, 0, "system", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r["conv_id"], r["part"], r["assistant"]): r for r in chat_format.op5_chat_format(spark, str(tmp_path)).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or "", r[3]))
        for me in {r[2] for r in mine} - {"system", None}:
            for p in range(0, len(mine), 128):
                heads = list(dict.fromkeys(r[3] for r in mine[:p] if r[2] == "system"))
                text, spans = "".join(f"<|system|>\n{h}\n<|end|>\n" for h in heads), []
                for _, _, role, body in mine[p:p + 128]:
                    text += {None: "<|user|>", "system": "<|system|>", me: "<|assistant|>"}.get(role, f"<|user name={role}|>") + "\n"
                    at = len(text)
                    text += body + "\n<|end|>\n"
                    if role == me:
                        spans.append(f"{at}-{len(text)}")
                want[(conv, p // 128, me)] = (text, ";".join(spans), len(mine[p:p + 128]), len(spans))
    assert set(got) == set(want) and (1, 2, "ann") in got
    for k, w in want.items():
        assert (got[k]["rendered"], got[k]["spans"], got[k]["n_turns"], got[k]["n_own"]) == w
    con = duckdb.connect()                                     # the SQL states the same beyond one part
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    stated = {(c, p, a): (text, spans, n, own) for c, p, a, n, own, text, spans in con.execute(chat_format.OP5_SQL).fetchall()}
    assert stated == want


# ---------------------------------------------------------------------- lm

def slow_score(words, ids, p):
    seq = [0, 0] + [ids[w] for w in words] + [0, 0]
    total = 0.0
    for i in range(2, len(seq) - 2):
        x = p["bias"].astype(float)
        for k, d in enumerate(lm_score.PLACES):
            x = x + p["embed"][seq[i + d], k * lm_score.HIDDEN:(k + 1) * lm_score.HIDDEN]
        h = np.tanh(x)
        c, m = divmod(seq[i], lm_score.MEMBERS)
        a, b = h @ p["cls"] + p["cls_bias"], h @ p["member"][c] + p["member_bias"][c]
        total += a[c] - np.log(np.exp(a).sum()) + b[m] - np.log(np.exp(b).sum())
    return total


def test_scores_of_awkward_rows(awkward, no_rows):
    top, params = lm_score.fit_model(awkward)
    rows = lm_score.score(awkward, top, params).collect()
    ids, p = lm_score.Ids(top), lm_score.views(params.astype(np.float64))
    texts = {}
    for i, t, *_ in awkward_rows():
        texts.setdefault(i, []).append((t or "").encode().lower().split())
    assert len(rows) == len(awkward_rows())
    for r in rows:
        w = [w for w in texts[r[lm_score.KEY_ID]] if len(w) == r["n_tokens"]]
        assert w
        if r["n_tokens"] == 0:
            assert r["log_likelihood"] == 0 and r["per_token"] is None
        elif r["n_tokens"] < 1000:
            assert any(abs(slow_score(x, ids, p) - r["log_likelihood"]) < 0.01 + 1e-4 * abs(r["log_likelihood"]) for x in w)
            assert abs(r["per_token"] * r["n_tokens"] - r["log_likelihood"]) < 1e-6 * abs(r["log_likelihood"]) + 1e-9
    top0, params0 = lm_score.fit_model(no_rows)
    assert top0 == [] and lm_score.score(no_rows, top0, params0).collect() == []


def test_gradient_is_the_derivative():
    rng = np.random.default_rng(0)
    v = rng.normal(0, 0.3, lm_score.SIZE)
    flat = np.concatenate([[0, 0], rng.integers(1, 200, 60), [0, 0], rng.integers(1, 200, 20), [0, 0]])
    g = np.empty(lm_score.SIZE)
    n = lm_score.gradient(lm_score.views(v), flat, 2, len(flat) - 2, g)
    loss = lambda x: -lm_score.log_likelihoods(lm_score.views(x), flat).sum() / n
    for i in [*np.argsort(-np.abs(g))[:8], *rng.integers(0, lm_score.SIZE, 4)]:
        step = np.zeros(lm_score.SIZE)
        step[i] = 1e-5
        assert abs((loss(v + step) - loss(v - step)) / 2e-5 - g[i]) < 1e-6


def test_training_beats_word_shares_and_notices_order(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts[:800])], "doc_id long, text string").coalesce(1)
    top, counts, total = lm_score.vocabulary(docs)
    top, params = lm_score.fit_model(docs)
    ids, start = lm_score.Ids(top), lm_score.initial(counts, total)
    rng = random.Random(1)
    mixed = []
    for t in texts[800:]:
        w = t.split()
        rng.shuffle(w)
        mixed.append(" ".join(w))
    mean = lambda p, ts: float(lm_score.log_likelihoods(lm_score.views(p), lm_score.padded(ts, ids)[0]).sum()
                               / sum(len(t.split()) for t in ts))
    held = texts[800:]
    assert mean(params, held) > mean(start, held) + 0.05
    assert mean(params, held) > mean(params, mixed) + 0.02


def test_vocabulary_counts_everything(awkward):
    top, counts, total = lm_score.vocabulary(awkward)
    words = [w for _, t, *_ in awkward_rows() for w in (t or "").encode().lower().split()]
    assert total == len(words)
    from collections import Counter
    want = sorted(Counter(words).items(), key=lambda x: (-x[1], x[0]))[:lm_score.TOP]
    assert list(zip(top, counts)) == want


def test_words_of_a_bucket_are_told_apart(spark, awkward, no_rows):
    """Each word's share in its bucket, from the counts of all words: against
    plain counting, for rows with and without counted words."""
    from collections import Counter
    counts = lm_score.word_counts(awkward)
    top, params = lm_score.fit_model(awkward, counts=counts)
    words, sums = lm_score.in_buckets(counts, top)
    count = Counter(w for _, t, *_ in awkward_rows() for w in (t or "").encode().lower().split())
    tail = {w: n for w, n in count.items() if w not in set(top)}
    assert len(tail) > 1000 and {bytes(r["word"]): r["n"] for r in words.collect()} == tail
    total = Counter()
    for w, n in tail.items():
        total[lm_score.bucket_of(w)] += n
    extra = lambda t: sum(np.log((tail.get(w, 0) - 0.25 if w in tail else 0.25) / max(total[lm_score.bucket_of(w)], 1))
                          for w in (t or "").encode().lower().split() if w not in set(top))
    rare, common = min(tail, key=tail.get).decode(), max(tail, key=tail.get).decode()
    new = spark.createDataFrame([(900, "neverseenword " * 3), (901, rare), (902, common), (903, None)], "doc_id long, text string")
    for df, texts in ((awkward, [(i, t) for i, t, *_ in awkward_rows()]), (new, [(r[0], r[1]) for r in new.collect()])):
        plain = {(r[0], r[1]): r for r in lm_score.score(df, top, params).collect()}
        got = lm_score.score_words(df, top, params, words, sums).collect()
        assert len(got) == len(texts)
        by = {}
        for i, t in texts:
            by.setdefault((i, len((t or "").split())), []).append(extra(t))
        for r in got:
            base = plain[(r[0], r[1])]
            assert r["n_tokens"] == base["n_tokens"] and (r["per_token"] is None) == (r["n_tokens"] == 0)
            assert any(abs(base["log_likelihood"] + x - r["log_likelihood"]) < 1e-6 * (1 + abs(r["log_likelihood"]))
                       for x in by[(r[0], r["n_tokens"])])
    assert lm_score.score_words(no_rows, top, params, words, sums).collect() == []


def test_the_query_sums_to_a_distribution(spark):
    """Over the counted words of a bucket and as many unseen ones the shares add up to 1."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = lm_score.word_counts(docs)
    words, sums = lm_score.in_buckets(counts, lm_score.vocabulary(docs)[0])
    for r in words.groupBy("id").agg(F.sum(F.col("n") - lm_score.DISCOUNT).alias("seen"), F.count("word").alias("k")).collect():
        assert abs((r["seen"] + r["k"] * lm_score.DISCOUNT) / sums[r["id"]] - 1) < 1e-9
