"""Substring dedup by relative Lempel-Ziv parsing against indexed blocks.

The words of earlier documents (smaller doc_id) are the reference of a
document.  A greedy parse cuts the document into factors, each a longest match
with the reference.  A factor of at least ``window`` words, or a stretch over a
factor boundary in which every run of ``window`` words occurs in some earlier
document, is a duplicate span; its words are removed.

How the reference is indexed and parsed against
-----------------------------------------------
* The reference is cut into blocks by content.  Among the 8-word sequences in
  each run of ``window`` words the one with the least hash (the minimizer)
  names the block that the run belongs to.  Equal runs have equal minimizers,
  so a run can only match inside its own block: sending each piece of a
  document (its consecutive runs with one minimizer) to that block parses the
  document against every block that can match it.
* A block's index maps the hash of each run to the least doc_id that has it.
  A piece is parsed against it greedily: a factor starts at a run that is in
  the index with a smaller doc_id and goes on run by run while the next one is
  too.  The next run's start differs from the last one's by one word, so the
  check also covers the boundary between two factors, whichever documents they
  match, and the boundary between pieces.
* The factors go back to their documents as bit masks of the runs.

The first step keeps only the least doc_id of each run in its chunk and marks
the rest as duplicates at once, so of a passage that a third of all documents
share each run is sent once a chunk.  The runs that lie half inside such a
passage differ from document to document, yet have its minimizers.  So blocks
that are frequent in a sample of the documents (``hot_blocks``; at most some
thousand numbers) are cut into ``SPLIT`` by the runs' hashes.  That only decides
which task looks at a run; any sample gives the same result.  Blocks are
streamed in sorted order; one is in memory at a time.

Hashes: 64 bits a word, a polynomial over them with an odd base, mixed; of a
run's hash 48 bits are sent, next to the block's 64.

Defined results
---------------
* Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null texts have none.
* A text of fewer than ``window`` words loses nothing.
* Runs are judged on the input, so each copy but that of the least doc_id goes.
* A run that is repeated within one document only stays.  Rows of the same
  doc_id do not count as earlier than each other.
* A null doc_id is later than any other: such rows lose what any row with an id
  has, and are never a reference.
* Columns other than doc_id and text are not read here; ``dedup`` returns them
  as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY_HASH, KEY_ID, chunks_of, doc_key, materialise, mix64, read_table

WINDOW, GRAM = 50, 8
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Parts of a hot block; share of sampled documents (and least number) that make one hot.
SPLIT, HOT_SHARE, HOT_LEAST = 64, 0.002, 12
LATEST = np.iinfo(np.int64).max
#: Bytes of text in one numpy pass of the first step.
CHUNK_BYTES = 12 << 20


class _WordHashes(dict):
    """word -> 64-bit hash, filled on demand."""

    def __missing__(self, word):
        self[word] = h = xxhash.xxh64_intdigest(word, 7)
        return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i < n."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, by doubling."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def runs_of(texts: list[str], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every run of ``window`` words of every text: number of the text,
    start in it, the run's hash and its minimizer."""
    hashes = _WordHashes()
    words, counts = [], np.empty(len(texts), np.int64)
    for k, t in enumerate(texts):
        w = t.encode().split()
        counts[k] = len(w)
        words.append(np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w)))
    total = int(counts.sum())
    if total < window:
        e = np.empty(0, np.int64)
        return e, e, e.astype(np.uint64), e.astype(np.uint64)
    up, down = _powers(total)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.concatenate(words) * up, dtype=np.uint64)])
    n = total - window + 1
    run = mix64((prefix[window:] - prefix[:-window]) * down[:n])
    grams = mix64((prefix[gram:] - prefix[:-gram]) * down[:total - gram + 1])
    least = sliding_min(grams, window - gram + 1)
    begins = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(texts)), counts)[:n]
    start = np.arange(n) - begins[text]
    whole = start + window <= counts[text]
    return text[whole], start[whole], run[whole], least[whole]


def _earliest(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row the least ``doc`` of the rows with its ``key``."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.concatenate([[0], np.nonzero(k[1:] != k[:-1])[0] + 1])
    low = np.minimum.reduceat(doc[order], first)
    out = np.empty(len(key), doc.dtype)
    out[order] = np.repeat(low, np.diff(np.concatenate([first, [len(k)]])))
    return out


PIECES = f"block long, {KEY_ID} long, {KEY_HASH} long, start int, marked long, open long, hashes binary"


def hot_blocks(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, one_in: int = 64) -> np.ndarray:
    """Blocks that are frequent among every ``one_in``-th document by hash."""
    def run(batches):
        for held in chunks_of(batches, CHUNK_BYTES):
            texts = [t or "" for b in held for t in b.column("text").to_pylist()]
            text, _, _, least = runs_of(texts, window, gram)
            pair = np.lexsort((least, text))
            text, least = text[pair], least[pair]
            once = np.concatenate([[True], (text[1:] != text[:-1]) | (least[1:] != least[:-1])])[:len(text)]
            block, n = np.unique(least[once], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(block.view(np.int64)), pa.array(n.astype(np.int64)),
                                              pa.array(np.zeros(len(n), np.int64))], names=["block", "n", "docs"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([0], pa.int64()),
                                              pa.array([len(texts)], pa.int64())], names=["block", "n", "docs"])
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text", F.lit("hot")), F.lit(one_in)) == 0).select("text")
    counts = materialise(sample.mapInArrow(run, "block long, n long, docs long")
                         .groupBy("block").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
                         .filter((F.col("n") >= HOT_LEAST) | F.col("block").isNull()), "block-counts")
    total = counts.agg(F.sum("docs")).first()[0] or 0
    # a text has few blocks, so those that a given share of the texts have are bounded
    rows = counts.filter(F.col("block").isNotNull() & (F.col("n") >= HOT_SHARE * total)).select("block").collect()
    return np.sort(np.array([r["block"] for r in rows], np.int64).view(np.uint64))


def pieces(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The pieces of every document: up to 64 consecutive runs with one
    minimizer (of a hot block, those of them in one part).  ``marked`` has a bit for each run that is known to be a
    duplicate already, ``open`` one for each that the block must decide, whose
    hashes (6 bytes each) follow."""
    hot = hot_blocks(docs, window, gram)

    def run(batches):
        for held in chunks_of(batches, CHUNK_BYTES):
            ids = np.concatenate([b.column(0).fill_null(LATEST).to_numpy() for b in held])
            keys = [pa.chunked_array([b.column(i) for b in held]) for i in (0, 1)]
            texts = [t or "" for b in held for t in b.column("text").to_pylist()]
            text, start, h, least = runs_of(texts, window, gram)
            if not len(h):
                continue
            doc = ids[text]
            local = _earliest(h, doc) < doc
            new = np.concatenate([[True], (text[1:] != text[:-1]) | (least[1:] != least[:-1]) | (start[1:] != start[:-1] + 1)])
            begin = np.nonzero(new)[0]
            offset = np.arange(len(h)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(h)]])))
            new |= offset % 64 == 0
            offset %= 64
            if len(hot):                       # all runs of a piece have one minimizer, so pieces are hot or not
                is_hot = hot[np.minimum(np.searchsorted(hot, least), len(hot) - 1)] == least
                if is_hot.any():
                    salt = h[is_hot] % np.uint64(SPLIT) + np.uint64(1)
                    number = np.cumsum(new)[is_hot]
                    order = np.lexsort((salt, number))
                    salt, number = salt[order], number[order]
                    pick = np.nonzero(is_hot)[0][order]
                    parts = np.concatenate([[True], (number[1:] != number[:-1]) | (salt[1:] != salt[:-1])])
                    yield from rows(keys, parts, text[pick], start[pick], h[pick], mix64(least[pick] + salt), offset[pick],
                                    local[pick])
                    cold = ~is_hot
                    text, start, h, least, offset, local, new = (
                        x[cold] for x in (text, start, h, least, offset, local, new))
            if len(h):
                yield from rows(keys, new, text, start, h, least, offset, local)

    def rows(keys, new, text, start, h, block, offset, local):
        begin = np.nonzero(new)[0]
        bit = np.uint64(1) << offset.astype(np.uint64)
        marked = np.bitwise_or.reduceat(np.where(local, bit, np.uint64(0)), begin)
        todo = np.bitwise_or.reduceat(np.where(local, np.uint64(0), bit), begin)
        six = np.ascontiguousarray(h[~local].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).reshape(-1)
        sent = np.add.reduceat((~local).astype(np.int64), begin) * 6
        ends = np.concatenate([[0], np.cumsum(sent)]).astype(np.int32)
        hashes = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(six)])
        at = pa.array(text[begin])
        out = pa.RecordBatch.from_arrays(
            [pa.array(block[begin].view(np.int64)), *[_combined(k.take(at)) for k in keys],
             pa.array((start - offset)[begin].astype(np.int32)), pa.array(marked.view(np.int64)), pa.array(todo.view(np.int64)),
             hashes], names=["block", KEY_ID, KEY_HASH, "start", "marked", "open", "hashes"])
        for k in range(0, out.num_rows, 20_000):
            yield out.slice(k, 20_000)

    return docs.select(*doc_key(), "text").mapInArrow(run, PIECES)


def _combined(c: pa.ChunkedArray) -> pa.Array:
    c = c.combine_chunks()
    return c if isinstance(c, pa.Array) else c.chunk(0)


def parse_block(block: np.ndarray, doc: np.ndarray, todo: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Of pieces sorted by block, the mask of those open runs that an earlier
    document has.  ``data``: the 6-byte hashes of all open runs."""
    n = np.bitwise_count(todo).astype(np.int64)
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = data.reshape(-1, 6)
    h = wide.view("<u8").reshape(-1)
    piece = np.repeat(np.arange(len(todo)), n)
    # the block's hash is folded in, so that only runs of one block can agree
    key = mix64(block.view(np.uint64)[piece]) ^ (h * np.uint64(0x9E3779B97F4A7C15))
    dup = _earliest(key, doc[piece]) < doc[piece] if len(key) else np.empty(0, bool)
    bits = ((todo[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(bool)
    where = np.nonzero(bits)[1].astype(np.uint64)          # row by row, as the hashes are
    out = np.zeros(len(todo), np.uint64)
    np.bitwise_or.at(out, piece[dup], np.uint64(1) << where[dup])
    return out


def factors(found: DataFrame) -> DataFrame:
    """Document key, start and mask of duplicate runs, of every piece that has any."""
    names = ["block", KEY_ID, KEY_HASH, "start", "marked", "open", "hashes"]

    def run(batches):
        held = None

        def solve(t: pa.Table):
            if not t.num_rows:
                return
            todo = t.column("open").to_numpy().view(np.uint64)
            hashes = _combined(t.column("hashes"))
            ends = np.frombuffer(hashes.buffers()[1], np.int32)[hashes.offset:hashes.offset + len(hashes) + 1]
            data = np.frombuffer(hashes.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
            mask = t.column("marked").to_numpy().view(np.uint64) | parse_block(
                t.column("block").to_numpy(), t.column(KEY_ID).fill_null(LATEST).to_numpy(), todo, data)
            hit = np.nonzero(mask)[0]
            if len(hit):
                at = pa.array(hit)
                yield pa.RecordBatch.from_arrays(
                    [_combined(t.column(c).take(at)) for c in (KEY_ID, KEY_HASH, "start")]
                    + [pa.array(mask[hit].view(np.int64))], names=[KEY_ID, KEY_HASH, "start", "mask"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch.select(names)])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            b = t.column("block").to_numpy()
            cut = int(np.argmax(b == b[-1]))               # the last block may go on
            yield from solve(t.slice(0, cut).combine_chunks())
            held = t.slice(cut)
        if held is not None:
            yield from solve(held.combine_chunks())

    return (found.repartition("block").sortWithinPartitions("block")
                 .mapInArrow(run, f"{KEY_ID} long, {KEY_HASH} long, start int, mask long"))


def covered(n_words: int, marks: list[tuple[int, int]], window: int) -> np.ndarray:
    """Which words the duplicate runs cover."""
    edge = np.zeros(n_words + 1, np.int64)
    for start, mask in marks:
        mask &= (1 << 64) - 1
        at = start + np.nonzero((np.uint64(mask) >> np.arange(64, dtype=np.uint64)) & np.uint64(1))[0]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
    return np.cumsum(edge[:-1]) > 0


def with_marks(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, columns: list[str] = ()) -> DataFrame:
    """Document key, text, the named columns and the marks of each document."""
    marks = (factors(pieces(docs, window, gram)).groupBy(KEY_ID, KEY_HASH)
             .agg(F.collect_set(F.struct("start", "mask")).alias("marks"))
             .select(F.coalesce(KEY_ID, F.lit(0)).alias("i"), F.col(KEY_ID).isNull().alias("no_id"),
                     F.col(KEY_HASH).alias("h"), "marks"))
    keyed = docs.select(*doc_key(), F.col("text").alias("_lf_text"),
                        F.struct(*[F.col(f"`{c}`") for c in columns] or [F.lit(0)]).alias("_lf_row"))
    same = ((F.coalesce(keyed[KEY_ID], F.lit(0)) == marks["i"]) & (keyed[KEY_ID].isNull() == marks["no_id"])
            & (keyed[KEY_HASH] == marks["h"]))
    return keyed.join(marks, same, "left").drop("i", "no_id", "h")


def cleaned(marked: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """Adds n_words, n_removed and either the kept text (unchanged if nothing
    is removed) or the sha256 of the kept words joined by one space."""
    extra = "clean string" if keep_text else "kept_sha256 string"
    schema = marked.drop("marks", "_lf_text").schema
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, out = [], [], []
        for text, marks in zip(batch.column("_lf_text"), batch.column("marks")):
            text, marks = text.as_py(), marks.as_py()
            words = (text or "").encode().split()
            gone = 0
            if marks:
                cover = covered(len(words), [(m["start"], m["mask"]) for m in marks], window)
                gone = int(cover.sum())
                words_kept = [w for w, c in zip(words, cover.tolist()) if not c]
            else:
                words_kept = words
            n_words.append(len(words))
            n_removed.append(gone)
            if keep_text:
                out.append(b" ".join(words_kept).decode() if gone else text)
            else:
                out.append(hashlib.sha256(b" ".join(words_kept)).hexdigest())
        cols = [batch.column(f.name) for f in schema.fields]
        return pa.RecordBatch.from_arrays(
            cols + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, pa.string())],
            names=[f.name for f in schema.fields] + ["n_words", "n_removed", extra.split()[0]])

    def over(batches):
        for b in batches:
            if b.num_rows:
                yield run(b)
    return marked.mapInArrow(over, f"{ddl}, n_words long, n_removed long, {extra}")


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with duplicate spans cut out of ``text`` and ``n_chars`` (if
    there is such a column) brought up to date.  Texts that lose nothing are
    unchanged, white space included; in others the words that stay are joined
    by one space.  A text that loses all its words stays as an empty one."""
    done = cleaned(with_marks(docs, window, gram, docs.columns), window, True)
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("clean").alias("text"))
        elif c == "n_chars":
            out.append(F.when(F.col("n_removed") > 0, F.length("clean")).otherwise(F.col("_lf_row.n_chars"))
                        .cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"_lf_row.`{c}`").alias(c))
    return done.select(*out)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = cleaned(with_marks(read_table(spark, sf_dir, "documents")), WINDOW, False)
    return done.select(F.col(KEY_ID).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
