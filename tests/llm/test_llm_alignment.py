"""Token alignment against the tokenizers themselves, whole texts, plain loops."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerforge.llm import token_alignment as T
from layerforge.llm.bpe import byte_letters
from layerforge.llm.common import KEY_ID
from layerforge.llm.pieces import vocabulary_path
from tests.llm.conftest import SF, awkward_rows


@pytest.fixture(scope="module")
def slow_groups():
    """text -> groups [(a ids, b ids, first byte)] of whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path(T.A_FILE))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(T.B_FILE))
    letters = byte_letters()
    vocab = json.load(open(vocabulary_path(T.A_FILE), encoding="utf-8"))["model"]["vocab"]
    a_bytes = {i: bytes(letters[c] for c in s) for s, i in vocab.items() if all(c in letters for c in s)}

    def b_bytes(i):
        piece = sp.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        raw = (" " + text).encode()
        a = [(i, a_bytes[i]) for i in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, b_bytes(i)) for i in sp.encode(text)]
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return []
        ends = []
        for side in (a, b):
            at, stops = 0, []
            for _, x in side:
                at += len(x)
                stops.append(at)
            ends.append(np.array(stops))
        out, i, k, first = [], 0, 0, 0
        for cut in np.intersect1d(*ends).tolist():
            i2, k2 = np.searchsorted(ends[0], cut, "right"), np.searchsorted(ends[1], cut, "right")
            out.append(([x for x, _ in a[i:i2]], [x for x, _ in b[k:k2]], first))
            i, k, first = i2, k2, cut
        return out
    return groups


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b, _ in groups)


def slow_rows(docs, slow_groups):
    """(doc_id, text) -> rows of the query, sorted."""
    links, counts, rows = [], Counter(), []
    for _, text in docs:
        c = Counter()
        for a, b, _ in slow_groups(text):
            for x, m in Counter(a).items():
                for y, n in Counter(b).items():
                    c[x, y] += m * n
        links.append(c)
        counts.update(c.keys())
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    for (i, text), c in zip(docs, links):
        g = slow_groups(text)
        rows.append((i, sum(len(a) for a, _, _ in g), sum(len(b) for _, b, _ in g), len(g), sum(c.values()),
                     sum(n for p, n in c.items() if counts[p] == highest[p[0]]), sum(n * counts[p] for p, n in c.items()),
                     hashlib.sha256(written(g).encode()).hexdigest() if g else ""))
    return sorted(rows, key=str)


STRANGE = ["", " ", "  ", " lead", "tail ", "a  b", "a▁b c", "x\x00y", "\t\n tab", "<0x0A> <s> <|endoftext|>", "　wide　",
           "naïve café ß", "日本語のテキスト と more", "👩‍👩‍👧 emoji 🏳️‍🌈", "don't we'll 's", "x" * 50_000, "ab" * 4000 + " " + "\U0001F600" * 900,
           "a\x1cb \x1c c", "͸ Ᲊ newer", "é combining", "1234567 89,000.5", "a b  c", "� ok"]


def test_groups_of_strange_texts(spark, slow_groups):
    rng = random.Random(3)
    pool = "".join(STRANGE[1:15]) + " " * 12
    texts = STRANGE + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "doc_id long, text string")
    got = {r[KEY_ID]: (r["groups"], list(r["starts"])) for r in T.align(df).collect()}
    for k, text in [*enumerate(texts), (-1, None)]:
        want = slow_groups(text)
        assert got[k] == (written(want), [s for _, _, s in want]), repr(text)


def test_intervals_coalesce():
    a, b = T.coalesce(*(np.array(x) for x in ([0, 2, 4, 9], [2, 4, 9, 10], [0, 4, 5, 9], [4, 5, 9, 10])))
    assert a.tolist() == [0, 0, 1, 2] and b.tolist() == [0, 1, 1, 2]
    a, b = T.coalesce(*[np.empty(0, np.int64)] * 4)
    assert not len(a) and not len(b)


def test_many_links_in_blocks(monkeypatch, slow_groups):
    """Blocks change nothing: all links of a chunk, expanded a few at a time."""
    texts = [t for _, t, *_ in awkward_rows() if t and len(t) < 5000]
    a, b = T.tokens(T.TokensA, vocabulary_path(T.A_FILE)), T.tokens(T.TokensB, vocabulary_path(T.B_FILE))
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({T.KEY_ID: list(range(len(texts))), T.KEY_HASH: [0] * len(texts), "text": texts})
    results = []
    for block in (7, 1 << 21):
        monkeypatch.setattr(T, "BLOCK", block)
        results.append([x.tolist() for x in T.Chunk([batch], a, b).links()])
    assert results[0] == results[1] and sum(results[0][1]) == sum(
        len(x) * len(y) for t in texts for x, y, _ in slow_groups(t))


def test_query_on_the_whole_table(spark, slow_groups):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, T.op11_token_alignment(spark, SF).collect()), key=str) == slow_rows(docs, slow_groups)


@pytest.mark.parametrize("chunk_bytes", [2000, 1 << 24])
def test_awkward_rows(awkward, no_rows, slow_groups, monkeypatch, chunk_bytes):
    monkeypatch.setattr(T, "CHUNK_BYTES", chunk_bytes)
    want = slow_rows([(i, t) for i, t, *_ in awkward_rows()], slow_groups)
    got = T.alignment_counts(awkward.repartition(3)).drop(T.KEY_HASH).collect()
    assert sorted(map(tuple, got), key=str) == want
    assert T.alignment_counts(no_rows).collect() == []
    assert T.alignment_counts(awkward.withColumn("text", F.lit(None).cast("string"))).agg(F.sum("n_links")).first()[0] == 0
