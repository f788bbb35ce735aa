"""Cross-tokenizer alignment by interval coalescing.

A text is cut by two tokenizers, A (byte-level BPE, over a space and the text) and
B (sentencepiece, which adds that space).  All tokens of both are intervals on one
byte axis.  They are sorted by start (lexsort), the running maximum of their ends
is taken (maximum.accumulate), and a group breaks where a start reaches it: at the
offsets where tokens of A and B both end.  Within a group all tokens overlap as far
as the coarsest cut can tell, and expand into links of each A with each B.

What is cut into groups once is each distinct piece (see ``pieces``) of a chunk
of documents: at a single space between other characters both tokenizers start a
token, so a group never crosses it, and a document's groups are those of its
pieces.  Links are expanded as distinct ids with their multiplicities.

A pair's count, the number of documents in which it is linked, covers the whole
corpus.  Documents are reduced to pairs once a task and chunk; the counts come
back to a chunk as one row for each of its distinct pairs, never one a document
and pair.

Defined results
---------------
* A text that is null, empty, or whose joined tokens are not the space and the
  text byte by byte (a literal U+2581, for B) has no tokens: zeros, no groups.
* Strings of special tokens in a text are plain text.
* Equal documents are documents like any other: each has a row, and each counts.
* An empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import _Numbers, byte_letters, gather
from .common import KEY_HASH, KEY_ID, chunks_of, doc_key, materialise, read_table, worker_cache
from .pieces import split_pieces, vocabulary_path

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text that share one table of pieces and one request for counts.
CHUNK_BYTES = 6 << 20
#: Distinct pieces that are cut into groups in one numpy pass.
PIECES = 20_000
#: Links that one numpy pass expands.
BLOCK = 1 << 19
#: A space that is not between two other characters.
_BESIDE_SPACE = re.compile(r" \s|\s |^\s|\s\Z")


class TokensA:
    """Ids and token bytes of a byte-level tokenizers file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocab.values()) + 1)
        added = {t["content"] for t in spec["added_tokens"]}
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if token in added else bytes(letters[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, pieces: list[str]):
        return (e.ids for e in self.tokenizer.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False))


class TokensB:
    """Ids and token bytes of a sentencepiece model that adds a space in front
    and lets no token go on beyond a space that follows another character."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a token of B crosses a space")
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                      for i, n in enumerate(names)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, pieces: list[str]):
        return self.model.encode(pieces, num_threads=1)


def tokens(kind, path: str):
    cache = worker_cache()
    if ("tokens", path) not in cache:
        cache["tokens", path] = kind(path)
    return cache["tokens", path]


def token_texts(size_a: int, size_b: int) -> list[str]:
    """``id,`` and ``id|`` of all ids of A, then ``id,`` and ``id;`` of B."""
    cache = worker_cache()
    if ("token texts", size_a, size_b) not in cache:
        cache["token texts", size_a, size_b] = [f"{i}{end}" for n, ends in ((size_a, ",|"), (size_b, ",;"))
                                                for end in ends for i in range(n)]
    return cache["token texts", size_a, size_b]


def cut(text: str) -> list[str]:
    """``split_pieces``; most texts need no look at each piece."""
    return split_pieces(text) if _BESIDE_SPACE.search(text) else text.split(" ")


def coalesce(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B interval, numbered along the axis."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reached = np.maximum.accumulate(end[order])
    breaks = np.concatenate([[False], start[order][1:] >= reached[:-1]]) if len(order) else np.empty(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group[:len(a_start)], group[len(a_start):]


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The concatenated ranges starts[i]..ends[i]."""
    n = ends - starts
    return np.arange(int(n.sum())) + np.repeat(starts - (np.cumsum(n) - n), n)


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of the weights of each."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    return keys[first], np.add.reduceat(weights, first)


def blocks(sizes: np.ndarray, most: int):
    """Ranges of consecutive entries whose sizes add up to about ``most``."""
    total, at = np.cumsum(sizes), 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield at, stop
        at = stop


class Pieces:
    """The groups and links of the distinct pieces of a chunk: what a document
    needs of them, gathered block by block."""

    def __init__(self, pieces: list[str], a: TokensA, b: TokensB):
        kept = {"whole": bool, "n_a": np.int32, "n_b": np.int32, "n_groups": np.int32, "n_links": np.int64, "length": np.int64,
                "group_start": np.int32, "pairs": np.int64, "times": np.int64, "n_pairs": np.int32}
        out: dict[str, list] = {c: [np.empty(0, kind)] for c, kind in kept.items()}
        self.strings: list[str] = []
        for at in range(0, len(pieces), PIECES):
            block = PieceBlock(pieces[at:at + PIECES], a, b)
            for c, kind in kept.items():
                out[c].append(getattr(block, c).astype(kind))
            self.strings += block.strings
        for c in kept:
            setattr(self, c, np.concatenate(out.pop(c)))
        self.group_ends = np.cumsum(self.n_groups, dtype=np.int64)
        self.pair_ends = np.cumsum(self.n_pairs, dtype=np.int64)


class PieceBlock:
    """The groups and links of some distinct pieces, on one byte axis."""

    def __init__(self, pieces: list[str], a: TokensA, b: TokensB):
        self.n = len(pieces)
        raw = [b" " + p.encode() for p in pieces]
        (a_ids, a_ends), (b_ids, b_ends) = self._flat(a.encode(pieces)), self._flat(b.encode(pieces))
        self.whole = self._whole(raw, a, a_ids, a_ends) & self._whole(raw, b, b_ids, b_ends)
        length = np.fromiter(map(len, raw), np.int64, self.n)
        base = np.cumsum(length) - length
        a_ids, a_piece, a_start, a_end = self._intervals(a, a_ids, a_ends, base)
        b_ids, b_piece, b_start, b_end = self._intervals(b, b_ids, b_ends, base)
        a_group, b_group = coalesce(a_start, a_end, b_start, b_end)
        groups = int(a_group[-1]) + 1 if len(a_group) else 0
        per_a, per_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        first_a, first_b = np.cumsum(per_a) - per_a, np.cumsum(per_b) - per_b
        of = a_piece[first_a] if groups else np.empty(0, np.int64)
        count = lambda piece, w=None: np.bincount(piece, weights=w, minlength=self.n).astype(np.int64)
        self.n_a, self.n_b, self.n_groups = count(a_piece), count(b_piece), count(of)
        self.group_start = a_start[first_a] - base[of] if groups else np.empty(0, np.int64)
        self.length = length
        self.n_links = np.zeros(self.n, np.int64)
        np.add.at(self.n_links, of, per_a * per_b)
        self.strings = self._strings(a_ids, a_group, b_ids, b_group, len(a.bytes), len(b.bytes))
        self.pairs, self.times, self.n_pairs = self._links(a_ids, a_group, b_ids, b_group, of, len(b.bytes))

    @staticmethod
    def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [], []
        for ids in lists:
            flat.extend(ids)
            sizes.append(len(ids))
        return np.array(flat, np.int64), np.cumsum(np.array(sizes, np.int64))

    def _whole(self, raw, tokens, ids, ends) -> np.ndarray:
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        if b"".join(map(tokens.bytes.__getitem__, ids.tolist())) == b"".join(raw):
            total = np.concatenate([[0], np.cumsum(tokens.lengths[ids])])
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            if np.array_equal(total[ends] - total[starts], sizes):
                return np.ones(len(raw), bool)
        return np.array([b"".join(map(tokens.bytes.__getitem__, ids[s:e].tolist())) == r for r, s, e in zip(raw, starts, ends)], bool)

    def _intervals(self, tokens, ids, ends, base):
        """Tokens of whole pieces: ids, piece, start and end on the common axis."""
        count = np.diff(ends, prepend=0)
        piece = np.repeat(np.arange(self.n), count)
        size = tokens.lengths[ids]
        stop = np.cumsum(size)
        before = np.concatenate([[0], stop])[ends - count]            # bytes of earlier pieces' tokens
        end = stop - np.repeat(before, count) + base[piece]
        keep = self.whole[piece]
        return ids[keep], piece[keep], (end - size)[keep], end[keep]

    def _strings(self, a_ids, a_group, b_ids, b_group, size_a, size_b) -> list[str]:
        """The groups of each piece, each with its ``;``.  A token's text holds
        what follows it, so a piece is one join of table entries."""
        last_a, last_b = (np.concatenate([g[1:] != g[:-1], [True]])[:len(g)] for g in (a_group, b_group))
        entry = np.concatenate([a_ids + size_a * last_a, 2 * size_a + b_ids + size_b * last_b])
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        table = token_texts(size_a, size_b)
        texts = list(map(table.__getitem__, entry[order].tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(texts[s:e]) for s, e in zip([0, *ends], ends)]

    def _links(self, a_ids, a_group, b_ids, b_group, of, size_b):
        """Distinct (a, b) of each piece, as a * |B| + b, with multiplicities."""
        width = np.int64(1) << 32
        ka, ma = summed(a_group * width + a_ids, np.ones(len(a_ids), np.int64))
        kb, mb = summed(b_group * width + b_ids, np.ones(len(b_ids), np.int64))
        per = np.bincount(kb // width, minlength=len(of)) if len(of) else np.empty(0, np.int64)
        ends = np.cumsum(per)
        ga = ka // width
        keys, times = [], []
        for lo, hi in blocks(per[ga], BLOCK):
            g = ga[lo:hi]
            n = per[g]
            other = ranges(ends[g] - n, ends[g])
            pair = np.repeat(ka[lo:hi] % width, n) * size_b + kb[other] % width
            k, t = summed(np.repeat(of[g], n) * width + pair, np.repeat(ma[lo:hi], n) * mb[other])
            keys.append(k)
            times.append(t)
        if not keys:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(self.n, np.int64)
        k, t = summed(np.concatenate(keys), np.concatenate(times)) if len(keys) > 1 else (keys[0], times[0])
        return k % width, t, np.bincount(k // width, minlength=self.n)


class Chunk:
    """The documents of some record batches as sequences of piece numbers."""

    def __init__(self, batches, a: TokensA, b: TokensB):
        self.keys = [pa.concat_arrays([x.column(c) for x in batches]) for c in (KEY_ID, KEY_HASH)]
        numbers, self.docs = _Numbers(), []
        for batch in batches:
            for text in batch.column("text").to_pylist():
                parts = cut(text) if text else []
                self.docs.append(np.fromiter(map(numbers.__getitem__, parts), np.int32, len(parts)))
        self.pieces = p = Pieces(list(numbers), a, b)
        # a text with a piece that does not come back byte by byte has no tokens
        self.docs = [d if p.whole[d].all() else d[:0] for d in self.docs]
        self.size = np.array([len(d) for d in self.docs], np.int64)

    def sums(self, of_piece: np.ndarray) -> np.ndarray:
        return np.array([of_piece[d].sum(dtype=np.int64) for d in self.docs], np.int64)

    def group_string(self, k: int) -> str:
        return "".join(map(self.pieces.strings.__getitem__, self.docs[k].tolist()))[:-1]

    def group_starts(self, k: int) -> np.ndarray:
        """Byte offsets in the space and the text at which groups start."""
        p, d = self.pieces, self.docs[k]
        at = np.cumsum(p.length[d]) - p.length[d]
        n = p.n_groups[d].astype(np.int64)
        return gather(p.group_start, p.group_ends[d] - n, p.group_ends[d]) + np.repeat(at, n)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs and multiplicities of all documents, and where each
        document's end."""
        p, width = self.pieces, np.int64(1) << 32
        out, sums, n_pairs = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(len(self.docs), np.int64)
        per = self.sums(p.n_pairs)
        for lo, hi in blocks(per, BLOCK):          # a block ends with a document
            doc = np.repeat(np.arange(lo, hi), self.size[lo:hi])
            at, often = summed(doc * width + np.concatenate(self.docs[lo:hi]), np.ones(len(doc), np.int64))
            doc, piece = at // width, at % width
            n, ends = p.n_pairs[piece].astype(np.int64), p.pair_ends[piece]
            entry = ranges(ends - n, ends)
            k, t = summed(np.repeat(doc, n) * width + p.pairs[entry], np.repeat(often, n) * p.times[entry])
            out.append(k % width)
            sums.append(t)
            n_pairs += np.bincount(k // width, minlength=len(self.docs))
        return np.concatenate(out), np.concatenate(sums), np.cumsum(n_pairs)


def chunks(batches, a_path: str, b_path: str):
    a, b = tokens(TokensA, a_path), tokens(TokensB, b_path)
    for held in chunks_of(batches, CHUNK_BYTES):
        yield Chunk(held, a, b)


def _paths(a_path, b_path):
    return a_path or vocabulary_path(A_FILE), b_path or vocabulary_path(B_FILE)


def _list(values: np.ndarray, ends: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(values.astype(kind)))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Document key, groups (``a1,a2|b1;a3|b2`` of ids) and starts (the byte of
    the space and the text at which each group starts)."""
    a_path, b_path = _paths(a_path, b_path)

    def run(batches):
        for c in chunks(batches, a_path, b_path):
            for at in range(0, len(c.docs), 500):
                part = range(at, min(at + 500, len(c.docs)))
                starts = [c.group_starts(k) for k in part]
                yield pa.RecordBatch.from_arrays(
                    [x.slice(at, len(part)) for x in c.keys]
                    + [pa.array([c.group_string(k) for k in part], pa.string()),
                       _list(np.concatenate(starts), np.cumsum([len(s) for s in starts]), np.int32)],
                    names=[KEY_ID, KEY_HASH, "groups", "starts"])
    return docs.select(*doc_key(), "text").mapInArrow(run, f"{KEY_ID} long, {KEY_HASH} long, groups string, starts array<int>")


def linked(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> tuple[DataFrame, int]:
    """For each document its key, chunk, n_a, n_b, n_groups, n_links, the digest
    of its groups, and its distinct linked pairs (a * |B| + b) with how often
    each is linked; and |B|."""
    a_path, b_path = _paths(a_path, b_path)
    sizes = len(tokens(TokensA, a_path).bytes), len(tokens(TokensB, b_path).bytes)
    kind, sql = (np.int32, "int") if sizes[0] * sizes[1] < 2 ** 31 else (np.int64, "long")

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for c in chunks(batches, a_path, b_path):
            pairs, times, ends = c.links()
            p = c.pieces
            sha = [hashlib.sha256(c.group_string(k).encode()).hexdigest() if len(d) else "" for k, d in enumerate(c.docs)]
            whole = pa.RecordBatch.from_arrays(
                [*c.keys, pa.array(np.full(len(c.docs), (part << 24) + n)), *(pa.array(c.sums(x)) for x in (p.n_a, p.n_b, p.n_groups, p.n_links)),
                 pa.array(sha, pa.string()), _list(pairs, ends, kind), _list(times, ends, np.int64)],
                names=[KEY_ID, KEY_HASH, "chunk", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
            for at in range(0, whole.num_rows, 500):
                yield whole.slice(at, 500)
            n += 1
    counts = "n_a long, n_b long, n_groups long, n_links long"
    return docs.select(*doc_key(), "text").mapInArrow(
        run, f"{KEY_ID} long, {KEY_HASH} long, chunk long, {counts}, groups_sha256 string, pairs array<{sql}>, times array<long>"), sizes[1]


def pair_counts(links: DataFrame, size_b: int) -> tuple[DataFrame, DataFrame]:
    """(pairs by chunk: chunk, pair; all pairs: pair, count, best: whether the
    count is the highest of its A id)."""
    by_chunk = materialise(links.select("chunk", F.explode("pairs").alias("pair")).groupBy("chunk", "pair")
                                .agg(F.count(F.lit(1)).alias("docs")), "chunk-pairs")
    counts = materialise(by_chunk.groupBy("pair").agg(F.sum("docs").alias("count")), "pair-counts")
    a = F.floor(F.col("pair") / size_b)
    highest = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    # one row an id of A: the vocabulary bounds what is broadcast
    best = counts.withColumn("a", a).join(F.broadcast(highest), "a")
    return by_chunk.select("chunk", "pair"), best.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _weigh(documents: pa.Table, weights: pa.Table) -> pa.Table:
    """One chunk: its documents and the counts of its pairs."""
    documents, weights = documents.combine_chunks(), weights.combine_chunks()
    pair = weights["pair"].to_numpy()
    order = np.argsort(pair)
    count, best = weights["count"].to_numpy()[order], weights["best"].to_numpy(zero_copy_only=False)[order]
    lists = documents["pairs"].combine_chunks()
    at = np.searchsorted(pair[order], lists.flatten().to_numpy())
    times = documents["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])

    def of_document(values):
        total = np.concatenate([[0], np.cumsum(values)])
        return pa.array((total[ends[1:]] - total[ends[:-1]]).astype(np.int64))

    columns = {c: documents[c] for c in (KEY_ID, KEY_HASH, "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(columns | {"n_best": of_document(times * best[at]), "count_sum": of_document(times * count[at]),
                               "groups_sha256": documents["groups_sha256"]})


def alignment_counts(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row for each document: key, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    links, size_b = linked(docs, a_path, b_path)
    links = materialise(links, "links")
    asked, counts = pair_counts(links, size_b)
    weights = asked.join(counts, "pair").select("chunk", "pair", "count", "best")
    schema = (f"{KEY_ID} long, {KEY_HASH} long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
              "count_sum long, groups_sha256 string")
    return links.groupBy("chunk").cogroup(weights.groupBy("chunk")).applyInArrow(_weigh, schema)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = alignment_counts(read_table(spark, sf_dir, "documents"))
    return r.select(F.col(KEY_ID).alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
