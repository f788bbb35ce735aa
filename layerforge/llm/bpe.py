"""Byte-level BPE encoding through a pair occurrence index, and decoding.

A partition's texts are cut into pieces (see ``pieces``) and those into
pre-tokens; each distinct pre-token is encoded once for a chunk of the
partition.  All their symbols lie in one array, linked by next and previous.
The index maps each rank to the positions at which its pair occurs.  Ranks are
applied in ascending order: all occurrences of the least active rank are merged
at once, and the pairs that the merges create to their left and right are
entered under their own ranks, which are greater (a pair that holds a symbol
can only be ranked after the merge that makes the symbol, and each symbol is
made by one merge; the loader checks this).

Defined results
---------------
* ids are those of the tokenizers library for the same file, without added
  tokens, truncation or padding; a special token's string in a text is one id.
* Decoding concatenates the tokens' bytes and reads them as UTF-8, with U+FFFD
  for what is not; text from ``encode`` comes back as it was.
* null and empty texts have no ids and decode to the empty text.
* Repeated rows are encoded like any other.  Columns other than doc_id and text
  are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY_HASH, KEY_ID, chunks_of, doc_key, read_table, worker_cache
from .pieces import split_pieces, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
#: Bytes of text that share one index.
CHUNK_BYTES = 32 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary files
    of this family: itself if printable in Latin-1, else 256 and up in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    out.update({chr(256 + i): b for i, b in enumerate(rest)})
    return out


class Vocabulary:
    """Merge ranks and token bytes of a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        import public_tokenizers
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.size = max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])]) + 1
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.of_byte = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.of_byte[b] = vocab[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        rank_of = {int(t): r for r, t in enumerate(self.made)}
        if len(rank_of) != len(merges) or any(rank_of.get(int(t), -1) >= r
                                              for r, ab in enumerate(zip(self.left, self.right)) for t in ab):
            raise ValueError("merges must make each symbol once, after its parts")
        keys = self.left * self.size + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.pattern = public_tokenizers.PATTERN
        self.plain = regex.compile(self.pattern)
        self.careful = None
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text.  The regex module may know a later Unicode
        version than the tokenizers library; beyond the oldest scripts the
        pattern is corrected for that."""
        if text.isascii() or max(text) < "\u0300":
            return self.plain.findall(text)
        if self.careful is None:
            later = "".join(f"\\U{ord(c):08X}" for c in newer_letters())
            self.careful = regex.compile(
                self.pattern.replace("[^\\s\\p{L}\\p{N}]", f"[[^\\s\\p{{L}}\\p{{N}}]||[{later}]]")
                .replace(" ?\\p{L}+", f" ?[\\p{{L}}--[{later}]]+").replace(" ?\\p{N}+", f" ?[\\p{{N}}--[{later}]]+")
                if later else self.pattern, regex.V1)
        return self.careful.findall(text)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it is not a merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)


def newer_letters() -> list[str]:
    """Letters and digits to the regex module that are neither to the
    tokenizers library: those of a later Unicode version.  Only characters
    that this Python's tables do not have yet can differ."""
    from tokenizers import pre_tokenizers
    parts = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    unknown = "".join(c for c in map(chr, range(0x300, 0x110000)) if unicodedata.category(c) == "Cn")
    return [c for c in regex.findall(r"[\p{L}\p{N}]", unknown) if len(parts("a" + c + "1")) == 3]


def vocabulary(path: str) -> Vocabulary:
    cache = worker_cache()
    if ("vocabulary", path) not in cache:
        cache["vocabulary", path] = Vocabulary(path)
    return cache["vocabulary", path]


def merge_all(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and where each word ends in it."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64), np.cumsum(lengths)
    sym = v.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    ends = np.cumsum(lengths)
    nxt = np.arange(1, total + 1)
    prv = np.arange(-1, total - 1)
    nxt[ends[lengths > 0] - 1] = -1
    prv[(ends - lengths)[lengths > 0]] = -1

    # the index: rank -> arrays of positions at which its pair starts
    at = np.nonzero(nxt >= 0)[0]
    rank = v.ranks(sym[at], sym[at + 1])
    at, rank = at[rank >= 0], rank[rank >= 0]
    order = np.argsort(rank, kind="stable")
    at, rank = at[order], rank[order]
    cut = np.nonzero(rank[1:] != rank[:-1])[0] + 1
    index: dict[int, list[np.ndarray]] = {}
    if len(rank):
        for r, p in zip(rank[np.concatenate([[0], cut])].tolist(), np.split(at, cut)):
            index[r] = [p]
    active = list(index)
    heapq.heapify(active)

    while active:
        r = heapq.heappop(active)
        a, b, made = int(v.left[r]), int(v.right[r]), int(v.made[r])
        lists = index.pop(r)
        p = lists[0] if len(lists) == 1 else np.concatenate(lists)
        q = nxt[p]
        live = (sym[p] == a) & (q >= 0) & (sym[q] == b)
        p = p[live]
        if not len(p):
            continue
        if a == b and len(p) > 1:              # in a run of one symbol take every other pair
            p = np.unique(p)
            q = nxt[p]
            idx = np.arange(len(p))
            begin = np.concatenate([[True], q[:-1] != p[1:]])
            p = p[(idx - np.maximum.accumulate(np.where(begin, idx, 0))) % 2 == 0]
        elif len(lists) > 1:
            p = np.unique(p)
        q = nxt[p]
        after = nxt[q]
        sym[p] = made
        sym[q] = -1
        nxt[p] = after
        has = after >= 0
        prv[after[has]] = p[has]
        # affected pairs: the one that ends in p, the one that starts there
        before = prv[p]
        start = np.concatenate([before[before >= 0], p[nxt[p] >= 0]])
        if a == b:
            start = np.unique(start)
        rank = v.ranks(sym[start], sym[nxt[start]])
        start, rank = start[rank >= 0], rank[rank >= 0]
        if not len(rank):
            continue
        order = np.argsort(rank, kind="stable")
        start, rank = start[order], rank[order]
        cut = np.nonzero(rank[1:] != rank[:-1])[0] + 1
        edges = [0, *cut.tolist(), len(rank)]
        for lo, hi in zip(edges, edges[1:]):
            new = int(rank[lo])
            if new in index:
                index[new].append(start[lo:hi])
            else:
                index[new] = [start[lo:hi]]
                heapq.heappush(active, new)
    alive = sym >= 0
    kept = np.concatenate([[0], np.cumsum(alive)])
    return sym[alive], kept[ends]


class _Numbers(dict):
    """key -> number, in order of first use."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def gather(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The concatenated slices values[starts[i]:ends[i]]."""
    n = ends - starts
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return values[np.repeat(starts, n) + step]


def encode_texts(texts: list[str], v: Vocabulary):
    """Yields the ids of each text; pre-tokens are shared among all of them."""
    pieces, firsts = _Numbers(), _Numbers()    # with a space in front, without
    plans = []
    for text in texts:
        plan = []                              # parts of a text between special tokens
        for part in (v.special_split.split(text) if v.special_split else [text]) if text else []:
            if part in v.special:
                plan.append(v.special[part])
            elif part:
                split = split_pieces(part)
                plan.append((firsts[split[0]], np.fromiter(map(pieces.__getitem__, split[1:]), np.int64, len(split) - 1)))
        plans.append(plan)
    words = _Numbers()

    def tokens_of(keys, lead):
        flat, ends = [], np.empty(len(keys), np.int64)
        for k, key in enumerate(keys):
            flat.extend([words[w] for w in v.pre_tokens(lead + key)])
            ends[k] = len(flat)
        return np.array(flat, np.int64), ends

    of_piece, of_first = tokens_of(pieces, " "), tokens_of(firsts, "")
    ids, word_ends = merge_all([w.encode() for w in words], v)
    word_starts = np.concatenate([[0], word_ends[:-1]]) if len(word_ends) else word_ends

    def resolve(table):                        # ids of each piece, in one array
        flat, ends = table
        count = (word_ends - word_starts)[flat]
        total = np.concatenate([[0], np.cumsum(count)])
        return gather(ids, word_starts[flat], word_ends[flat]), total[ends]

    piece_ids, piece_ends = resolve(of_piece)
    first_ids, first_ends = resolve(of_first)
    piece_starts = np.concatenate([[0], piece_ends[:-1]]) if len(piece_ends) else piece_ends
    first_starts = np.concatenate([[0], first_ends[:-1]]) if len(first_ends) else first_ends
    for plan in plans:
        out = []
        for step in plan:
            if isinstance(step, int):
                out.append(np.array([step], np.int64))
            else:
                f, rest = step
                out.append(first_ids[first_starts[f]:first_ends[f]])
                out.append(gather(piece_ids, piece_starts[rest], piece_ends[rest]))
        yield np.concatenate(out) if out else np.empty(0, np.int64)


def decode(ids: np.ndarray, v: Vocabulary) -> str:
    return b"".join(map(v.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Document key and ids (array of int)."""
    path = path or vocabulary_path(VOCABULARY)

    def run(batches):
        v = vocabulary(path)
        for keys, ids in _encoded(batches, v):
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32)
            yield pa.RecordBatch.from_arrays(keys + [pa.ListArray.from_arrays(ends, flat)], names=[KEY_ID, KEY_HASH, "ids"])
    return docs.select(*doc_key(), "text").mapInArrow(run, f"{KEY_ID} long, {KEY_HASH} long, ids array<int>")


def _encoded(batches, v: Vocabulary, rows: int = 2000):
    """(key columns, ids of each row) for slices of at most ``rows`` rows."""
    for held in chunks_of(batches, CHUNK_BYTES):
        texts = [t or "" for b in held for t in b.column("text").to_pylist()]
        ids = encode_texts(texts, v)
        for b in held:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                yield part.columns[:2], [next(ids) for _ in range(part.num_rows)]


def decoded(encodings: DataFrame, path: str | None = None) -> DataFrame:
    """Document key and text of ``encode``'s result."""
    path = path or vocabulary_path(VOCABULARY)

    def run(batches):
        v = vocabulary(path)
        for b in batches:
            if b.num_rows:
                texts = [decode(np.array(x.as_py() or [], np.int64), v) for x in b.column("ids")]
                yield pa.RecordBatch.from_arrays([b.column(KEY_ID), b.column(KEY_HASH), pa.array(texts, pa.string())],
                                                 names=[KEY_ID, KEY_HASH, "text"])
    return encodings.mapInArrow(run, f"{KEY_ID} long, {KEY_HASH} long, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encodes and decodes in one pass: document key, n_tokens and the digests
    of the ids (little-endian, 32 bits) and of the decoded text."""
    path = path or vocabulary_path(VOCABULARY)

    def run(batches):
        v = vocabulary(path)
        for keys, ids in _encoded(batches, v):
            yield pa.RecordBatch.from_arrays(
                keys + [pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(decode(x, v).encode()).hexdigest() for x in ids])],
                names=[KEY_ID, KEY_HASH, "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(*doc_key(), "text").mapInArrow(
        run, f"{KEY_ID} long, {KEY_HASH} long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (round_trip(read_table(spark, sf_dir, "documents"))
            .select(F.col(KEY_ID).alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256"))
