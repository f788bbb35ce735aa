"""Masked pseudo-likelihood scores from a bidirectional window network.

The network predicts each word from the two words on either side: the context's
embeddings (one table for each place) are added, go through tanh, and a
two-level softmax gives the probability of the id's class and of the id in its
class.  Frequent words have an id of their own; the others share the ids of
hash buckets, and the share of the word in its bucket is multiplied in.  A
document's score is the sum of the logarithms over all its words.

Everything is learned from all documents.
* Words are counted over the whole corpus, into a written table of every word,
  its id and its count.  Only the ``TOP`` most frequent words and the sums of
  the buckets reach the driver.
* The words of a chunk of documents that lie in buckets are joined with that
  table, one row for each distinct word of the chunk, and come back to the chunk.
* Training is one pass over all documents, in ``rounds`` rounds that split them
  by a hash.  In a round each task starts from the same parameters, runs
  minibatch Adagrad over all its documents, and sends its parameters (about
  330 KB); their average, weighted by words, starts the next round.  The average
  is taken in two steps, so that no task reads those of all others.
* The driver holds one set of parameters, whatever the input's size.

Defined results
---------------
* Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; places beyond either
  end of the text hold a padding id.
* null texts and texts without words: no words, score 0, mean null.
* Repeated rows are trained on as often as they occur and score alike.
* A word counted n times in a bucket of N has the share (n - DISCOUNT) / N of
  it.  What is taken off goes to as many unseen words as the bucket has words:
  one that was never counted has the share DISCOUNT / N.
* An empty table gives no rows.  Columns other than doc_id and text are not
  read.
* Scores depend, within the noise of training, on how the input is split.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY_HASH, KEY_ID, chunks_of, doc_key, materialise, read_table

CLASSES, MEMBERS, HIDDEN, SPAN = 32, 32, 16, 2
VOCAB = CLASSES * MEMBERS
TOP = 768                                      # ids 1..TOP; 0 is padding
BUCKETS = VOCAB - 1 - TOP
PLACES = [d for d in range(-SPAN, SPAN + 1) if d]
BLOCKS, FAN = 16, 256
#: What is taken off each count of a word in a bucket, for unseen words.
DISCOUNT = 0.25
#: Distinct words that a task counts before it sends them on.
COUNT_MEMORY = 500_000
CHUNK_BYTES = 8 << 20
SENT = ["chunk", "word", "bucket", "refs"]
BATCH, RATE = 8192, 0.3


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


# -------------------------------------------------------------- vocabulary

def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word occurs; the null word has the sum of all."""
    def count(batches):
        def out(c, total):
            words, n = list(c) + [None], list(c.values()) + [total]
            for at in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[at:at + 50_000], pa.binary()),
                                                  pa.array(n[at:at + 50_000], pa.int64())], names=["word", "n"])
        c, total = Counter(), 0
        for batch in batches:
            for text in batch.column("text"):
                w = words_of(text.as_py())
                total += len(w)
                c.update(w)
                if len(c) > COUNT_MEMORY:
                    yield from out(c, total)
                    c, total = Counter(), 0
        yield from out(c, total)

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame) -> tuple[list[bytes], list[int], int]:
    """The ``TOP`` most frequent words (ties by bytes), how often each occurs,
    and how many words the corpus has."""
    return frequent(word_counts(docs))


def frequent(counts: DataFrame) -> tuple[list[bytes], list[int], int]:
    """``vocabulary`` from the counts."""
    rows = counts.orderBy(F.col("word").isNull().desc(), F.col("n").desc(), "word").limit(TOP + 1).collect()
    total = sum(r["n"] for r in rows if r["word"] is None)
    top = [(bytes(r["word"]), r["n"]) for r in rows if r["word"] is not None]
    return [w for w, _ in top], [n for _, n in top], total


def bucket_of(word: bytes) -> int:
    return 1 + TOP + xxhash.xxh32_intdigest(word) % BUCKETS


class Ids(dict):
    """word -> id."""

    def __init__(self, top: list[bytes]):
        self.top = {w: i + 1 for i, w in enumerate(top)}
        super().__init__(self.top)

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
            self.update(self.top)
        self[word] = i = bucket_of(word)
        return i


class Numbers(dict):
    """word -> its number within a chunk: the id of a frequent word, from
    TOP + 1 on that of any other in the order of appearance."""

    def __init__(self, top: list[bytes]):
        super().__init__((w, i + 1) for i, w in enumerate(top))
        self.frequent, self.buckets = len(top), []

    def __missing__(self, word: bytes) -> int:
        self.buckets.append(bucket_of(word))
        self[word] = i = TOP + len(self.buckets)
        return i

    def ids(self) -> np.ndarray:
        """The id of each number."""
        return np.concatenate([np.arange(TOP + 1), np.array(self.buckets, np.int64)])

    def others(self) -> list[bytes]:
        return list(self)[self.frequent:]


def in_buckets(counts: DataFrame, top: list[bytes]) -> tuple[DataFrame, np.ndarray]:
    """The table of all words that share a bucket (word, id, n), written, and
    the sum of n for each id."""
    def place(batches):
        known = set(top)
        for batch in batches:
            words = batch.column("word").to_pylist()
            at = [i for i, w in enumerate(words) if w is not None and w not in known]
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[i] for i in at], pa.binary()), pa.array([bucket_of(words[i]) for i in at], pa.int32()),
                 batch.column("n").take(pa.array(at, pa.int64()))], names=["word", "id", "n"])

    table = materialise(counts.mapInArrow(place, "word binary, id int, n long"), "lm-words")
    sums = np.zeros(VOCAB, np.int64)
    for r in table.groupBy("id").agg(F.sum("n").alias("n")).collect():
        sums[r["id"]] = r["n"]
    return table, sums


def padded(texts: list[str | None], ids: Ids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts with ``SPAN`` padding ids (0) around each, where each
    text starts in them, and its number of words."""
    parts, n = [np.zeros(SPAN, np.int64)], np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        w = words_of(t)
        n[k] = len(w)
        parts += [np.fromiter(map(ids.__getitem__, w), np.int64, len(w)), np.zeros(SPAN, np.int64)]
    return np.concatenate(parts), SPAN + np.concatenate([[0], np.cumsum(n + SPAN)])[:-1], n


# ----------------------------------------------------------------- network

# one row of ``embed`` holds a word's embedding for each place, side by side
SHAPES = {"embed": (VOCAB, len(PLACES) * HIDDEN), "bias": (HIDDEN,), "cls": (HIDDEN, CLASSES), "cls_bias": (CLASSES,),
          "member": (CLASSES, HIDDEN, MEMBERS), "member_bias": (CLASSES, MEMBERS)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The parameters in one vector, by name."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def initial(counts: list[int], total: int, seed: int = 11) -> np.ndarray:
    """Small random weights; biases that give the words' overall shares."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(SIZE, np.float32)
    p = views(flat)
    p["embed"][:] = rng.normal(0, 0.1, SHAPES["embed"])
    p["cls"][:] = rng.normal(0, 0.1, SHAPES["cls"])
    p["member"][:] = rng.normal(0, 0.1, SHAPES["member"])
    share = np.full(VOCAB, 0.5)
    share[1:1 + len(counts)] += counts
    share[1 + TOP:] += max(total - sum(counts), 0) / BUCKETS
    share = (share / share.sum()).reshape(CLASSES, MEMBERS)
    p["cls_bias"][:] = np.log(share.sum(1))
    p["member_bias"][:] = np.log(share / share.sum(1, keepdims=True))
    return flat


def hidden(p: dict, flat: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Hidden layer of the places lo..hi-1, which have SPAN ids on either side."""
    rows = p["embed"].take(flat[lo - SPAN:hi + SPAN], axis=0)
    n, x = hi - lo, p["bias"] + np.zeros((hi - lo, 1), p["bias"].dtype)
    for k, d in enumerate(PLACES):
        x += rows[SPAN + d:SPAN + d + n, k * HIDDEN:(k + 1) * HIDDEN]
    return np.tanh(x, out=x)


def log_softmax(x: np.ndarray) -> np.ndarray:
    if x.max(initial=0) > 50:                  # else the exponentials cannot overflow
        x -= x.max(1, keepdims=True)
    x -= np.log(np.exp(x) @ np.ones(x.shape[1], x.dtype))[:, None]
    return x


def by_class(word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the places by class, padding left out; the class and member of
    each, and where each class starts."""
    order = np.argsort((word // MEMBERS).astype(np.uint8), kind="stable")
    order = order[word[order] > 0]
    word = word[order]
    cls = word // MEMBERS
    return order, cls, word % MEMBERS, np.searchsorted(cls, np.arange(CLASSES + 1))


def log_likelihoods(p: dict, flat: np.ndarray, step: int = 32_768) -> np.ndarray:
    """Log-probability of the word at each place given those around it; 0 for
    padding."""
    out = np.zeros(len(flat), p["bias"].dtype)
    for lo in range(SPAN, len(flat) - SPAN, step):
        hi = min(lo + step, len(flat) - SPAN)
        order, cls, member, edge = by_class(flat[lo:hi])
        h = hidden(p, flat, lo, hi).take(order, axis=0)
        row = np.arange(len(order))
        got = log_softmax(h @ p["cls"] + p["cls_bias"])[row, cls]
        for c in range(CLASSES):
            a, b = edge[c], edge[c + 1]
            if a < b:
                got[a:b] += log_softmax(h[a:b] @ p["member"][c] + p["member_bias"][c])[row[:b - a], member[a:b]]
        out[lo + order] = got
    return out


def gradient(p: dict, flat: np.ndarray, lo: int, hi: int, out: np.ndarray) -> int:
    """Gradient of the mean negative log-likelihood of the places lo..hi-1, into
    ``out``; the number of words among them."""
    g = views(out)
    out[:] = 0
    order, cls, member, edge = by_class(flat[lo:hi])
    n, row = len(order), np.arange(len(order))
    if not n:
        return 0
    h = hidden(p, flat, lo, hi).take(order, axis=0)
    err = np.exp(log_softmax(h @ p["cls"] + p["cls_bias"]))
    err[row, cls] -= 1
    g["cls"][:] = h.T @ err
    g["cls_bias"][:] = err.sum(0)
    back = err @ p["cls"].T
    for c in range(CLASSES):
        a, b = edge[c], edge[c + 1]
        if a < b:
            err = np.exp(log_softmax(h[a:b] @ p["member"][c] + p["member_bias"][c]))
            err[row[:b - a], member[a:b]] -= 1
            g["member"][c] = h[a:b].T @ err
            g["member_bias"][c] = err.sum(0)
            back[a:b] += err @ p["member"][c].T
    back *= 1 - h * h
    g["bias"][:] = back.sum(0)
    # each word's row collects what the places around its occurrences pass back
    m = hi - lo
    passed = np.zeros((m, HIDDEN), back.dtype)
    passed[order] = back
    wide = np.zeros((m + 2 * SPAN, len(PLACES) * HIDDEN), back.dtype)
    for k, d in enumerate(PLACES):
        wide[SPAN + d:SPAN + d + m, k * HIDDEN:(k + 1) * HIDDEN] = passed
    around = flat[lo - SPAN:hi + SPAN]
    order = np.argsort(around.astype(np.uint16), kind="stable")
    around = around[order]
    first = np.concatenate([[0], np.nonzero(around[1:] != around[:-1])[0] + 1])
    g["embed"][around[first]] = np.add.reduceat(wide.take(order, axis=0), first, axis=0)
    out /= n
    return n


def train(start: np.ndarray, stream, rate: float = RATE, batch: int = BATCH) -> tuple[np.ndarray, int]:
    """Adagrad over a stream of padded ids; the parameters and how many words
    they have seen."""
    params, grad = start.copy(), np.empty(SIZE, np.float32)
    seen, p, words = np.full(SIZE, 1e-4, np.float32), views(params), 0
    for flat in stream:
        for lo in range(SPAN, len(flat) - SPAN, batch):
            n = gradient(p, flat, lo, min(lo + batch, len(flat) - SPAN), grad)
            if n:
                seen += grad * grad
                params -= rate * grad / np.sqrt(seen)
                words += n
    return params, words


# -------------------------------------------------------------- on the corpus

def _texts(batches):
    for held in chunks_of(batches, CHUNK_BYTES):
        yield held, [t for b in held for t in b.column("text").to_pylist()]


def train_round(docs: DataFrame, top: list[bytes], params: np.ndarray) -> np.ndarray:
    """One round: each task trains on its documents, the results are averaged."""
    edges = np.linspace(0, SIZE, BLOCKS + 1).astype(int).tolist()

    def fit(batches):
        ids = Ids(top)
        found, words = train(params, (padded(t, ids)[0] for _, t in _texts(batches)))
        if words:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BLOCKS), pa.int32()), pa.array([words] * BLOCKS, pa.int64()),
                 pa.array([found[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())],
                names=["block", "words", "values"])

    def average(table):
        words = table.column("words").to_numpy()
        total = sum(w * np.frombuffer(v.as_py(), np.float32).astype(np.float64)
                    for w, v in zip(words.tolist(), table.column("values")))
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                         "words": pa.array([int(words.sum())], pa.int64()),
                         "values": pa.array([(total / words.sum()).astype(np.float32).tobytes()], pa.binary())})

    schema = "block int, words long, values binary"
    sent = docs.mapInArrow(fit, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    part = sent.groupBy("block", "salt").applyInArrow(average, schema)
    rows = part.groupBy("block").applyInArrow(average, schema).collect()
    if not rows:
        return params
    return np.concatenate([np.frombuffer(r["values"], np.float32) for r in sorted(rows, key=lambda r: r["block"])])


def fit_model(docs: DataFrame, rounds: int = 2, counts: DataFrame | None = None) -> tuple[list[bytes], np.ndarray]:
    """Frequent words and parameters from one pass over all documents."""
    top, n, total = frequent(word_counts(docs) if counts is None else counts)
    params = initial(n, total)
    keyed = docs.select(*doc_key(), "text")
    turn = F.pmod(F.xxhash64(KEY_ID, KEY_HASH, F.lit("round")), F.lit(rounds))
    for k in range(rounds):
        params = train_round(keyed.filter(turn == k).select("text"), top, params)
    return top, params


def score(docs: DataFrame, top: list[bytes], params: np.ndarray) -> DataFrame:
    """Document key, n_tokens, log_likelihood (sum) and per_token (mean) of the
    network's ids: words that share a bucket are not told apart."""
    def run(batches):
        ids, p = Ids(top), views(params)
        for held, texts in _texts(batches):
            flat, starts, n = padded(texts, ids)
            sums = np.concatenate([[0.0], np.cumsum(log_likelihoods(p, flat), dtype=np.float64)])
            total = sums[starts + n] - sums[starts]
            lo = 0
            for b in held:
                hi = lo + b.num_rows
                s, m = total[lo:hi], n[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:2], pa.array(m), pa.array(s), pa.array(s / np.maximum(m, 1), mask=m == 0)],
                    names=[KEY_ID, KEY_HASH, "n_tokens", "log_likelihood", "per_token"])
                lo = hi
    return docs.select(*doc_key(), "text").mapInArrow(
        run, f"{KEY_ID} long, {KEY_HASH} long, n_tokens long, log_likelihood double, per_token double")


def score_words(docs: DataFrame, top: list[bytes], params: np.ndarray, words: DataFrame, sums: np.ndarray) -> DataFrame:
    """As ``score``, with the share of each word in its bucket; ``words`` and
    ``sums`` are those of ``in_buckets``."""
    def run(batches):
        # a chunk's distinct words, each with its places' documents; last, under
        # a name that no word can have, the network's scores of the documents
        p, partition = views(params), TaskContext.get().partitionId()
        for k, (held, texts) in enumerate(_texts(batches)):
            chunk, numbers = (partition << 32) + k, Numbers(top)
            flat, starts, n = padded(texts, numbers)
            sum_to = np.concatenate([[0.0], np.cumsum(log_likelihoods(p, numbers.ids()[flat]), dtype=np.float64)])
            doc = np.repeat(np.arange(len(texts), dtype=np.int32), n)
            number = flat[flat > 0]
            doc, number = doc[number > TOP], number[number > TOP] - TOP - 1
            docs_of = doc[np.argsort(number, kind="stable")]
            m = len(numbers.buckets)
            edges = np.concatenate([[0], np.cumsum(4 * np.bincount(number, minlength=m))]).astype(np.int32)
            refs = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(edges), pa.py_buffer(docs_of)])
            others = pa.array(numbers.others(), pa.binary())
            for lo in range(0, m, 50_000):
                size = min(50_000, m - lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, chunk)), others.slice(lo, size),
                     pa.array(numbers.buckets[lo:lo + size], pa.int32()), refs.slice(lo, size)], names=SENT)
            key = pa.Table.from_batches(held).combine_chunks()
            scored = pa.table([key.column(0), key.column(1), pa.array(n), pa.array(sum_to[starts + n] - sum_to[starts])],
                              names=[KEY_ID, KEY_HASH, "n_tokens", "log_likelihood"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, scored.schema) as out:
                out.write_table(scored)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([b" %d" % chunk], pa.binary()), pa.array([0], pa.int32()),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=SENT)

    def finish(table):
        ids = table.column("bucket").to_numpy()
        n = table.column("n").fill_null(0).to_numpy()
        share = np.log(np.where(n > 0, n - DISCOUNT, DISCOUNT) / np.maximum(sums[ids], 1))
        refs = table.column("refs").to_pylist()
        scored = pa.ipc.open_stream(refs[int(np.nonzero(ids == 0)[0][0])]).read_all()
        word = np.nonzero(ids > 0)[0]
        times = np.array([len(refs[i]) // 4 for i in word], np.int64)
        doc = np.frombuffer(b"".join(refs[i] for i in word), np.int32)
        s = scored.column("log_likelihood").to_numpy() + np.bincount(doc, np.repeat(share[word], times), scored.num_rows)
        m = scored.column("n_tokens").to_numpy()
        return pa.table([*scored.columns[:3], pa.array(s), pa.array(s / np.maximum(m, 1), mask=m == 0)],
                        names=[KEY_ID, KEY_HASH, "n_tokens", "log_likelihood", "per_token"])

    sent = docs.select(*doc_key(), "text").mapInArrow(run, "chunk long, word binary, bucket int, refs binary")
    return (sent.join(words.select("word", "n"), "word", "left").select("chunk", "bucket", "refs", "n")
            .groupBy("chunk").applyInArrow(
                finish, f"{KEY_ID} long, {KEY_HASH} long, n_tokens long, log_likelihood double, per_token double"))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    counts = materialise(word_counts(docs), "lm-counts")
    top, params = fit_model(docs, counts=counts)
    scored = score_words(docs, top, params, *in_buckets(counts, top))
    return scored.select(F.col(KEY_ID).alias("doc_id"), "n_tokens", "log_likelihood", "per_token")
