"""SimHash near-dedup with multi-index hashing.

A fingerprint is cut into ``segments`` parts.  If two fingerprints differ in at
most k bits, they differ in at most floor(k / segments) bits in some part.  So
each part is a hash table of all fingerprints, and every fingerprint looks up
the small Hamming ball around its own value in each table; what it finds is
verified by the whole distance.  Of two different values of a part the larger
one looks up the smaller, which halves the look-ups and finds each pair still.

At scale
--------
* Equal fingerprints are one entry, so a group of copies of any size is one
  fingerprint by the time tables are built.
* Look-ups meet tables by a shuffle on (part, value).  A value with more than
  ``block`` entries is split: its entries go to several tasks, and each of its
  look-ups to one of them.
* A task emits its verified links, reduced to a spanning forest where they are
  more than the fingerprints they join, never all pairs of a group.
* Components are found by alternating large-star and small-star rounds, each
  written to the shared folder; nothing is collected.
* For N fingerprints the expected look-up cost is lowest at parts of about
  log2(N) bits: 3 up to some 10^8 fingerprints, 2 beyond.  The result is the
  same for any number of parts.

Defined results
---------------
Null and empty texts, and those of white space only, have fingerprint zero and
are linked like any other.  Texts shorter than a shingle have one shingle, all
their words.  Repeated rows share a fingerprint and a component.  Null ids are
never the smallest id of a component; a component of null ids only has a null
id.  An empty table gives no rows.  Columns other than doc_id and text are not
read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY_HASH, KEY_ID, arrow_map, doc_key, keep_rows, materialise, read_table

SHINGLE, MAX_BITS, SEED = 4, 4, 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text, as an unsigned integer."""
    words = text.encode().lower().split()      # both act on ASCII only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())],
                 np.uint64)
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(0, dtype=np.int64) > len(h)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Document key and fingerprint (the 64 bits as a signed long)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t.as_py() or "", shingle) for t in batch.column("text")], np.uint64)
        return pa.RecordBatch.from_arrays(batch.columns[:2] + [pa.array(fp.view(np.int64))],
                                          names=[KEY_ID, KEY_HASH, "fp"])
    return arrow_map(docs.select(*doc_key(), "text"), run, f"{KEY_ID} long, {KEY_HASH} long, fp long")


# ------------------------------------------------------------------- links

def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each part."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def ball_masks(width: int, radius: int) -> np.ndarray:
    """All values of ``width`` bits with at most ``radius`` of them set."""
    return np.array([sum(1 << b for b in bits) for r in range(radius + 1)
                     for bits in itertools.combinations(range(width), r)], np.uint64)


def look_ups(fps: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """One row (part, value, fp, own) for each value in the lower half of the
    Hamming ball of each part; ``own`` marks the part's value itself, which
    also is the table entry."""
    radius = max_bits // segments

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        parts, values, owners, own = [], [], [], []
        for part, (low, width) in enumerate(segment_bounds(segments)):
            value = (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)
            masks = ball_masks(width, radius)
            for at in range(0, len(masks), 64):
                near = value[:, None] ^ masks[None, at:at + 64]
                row, col = np.nonzero(near <= value[:, None])
                parts.append(np.full(len(row), part, np.int32))
                values.append(near[row, col])
                owners.append(fp[row])
                own.append(col + at == 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(parts)), pa.array(np.concatenate(values).view(np.int64)),
             pa.array(np.concatenate(owners).view(np.int64)), pa.array(np.concatenate(own))],
            names=["part", "value", "fp", "own"])
    return arrow_map(fps.select("fp"), run, "part int, value long, fp long, own boolean")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components in at most one link a node: each node to the least
    of its component (pointer jumping)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[moved], nodes[label[moved]]


def verified(group: np.ndarray, fp: np.ndarray, entry: np.ndarray, query: np.ndarray, max_bits: int,
             pairs_at_once: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Links between the look-ups and the entries of each group; rows are
    sorted by group."""
    first = np.concatenate([[True], group[1:] != group[:-1]])
    number = np.cumsum(first) - 1
    entries = np.nonzero(entry)[0]
    per_group = np.bincount(number[entries], minlength=number[-1] + 1)
    offset = np.concatenate([[0], np.cumsum(per_group)])[:-1]
    asks = np.nonzero(query)[0]
    many = per_group[number[asks]]
    asks, many = asks[many > 0], many[many > 0]
    ends = np.cumsum(many)
    out_a, out_b, done = [], [], 0
    while done < len(asks):
        to = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + pairs_at_once, "right")))
        q, m = asks[done:to], many[done:to]
        step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        x = np.repeat(fp[q], m)
        y = fp[entries[np.repeat(offset[number[q]], m) + step]]
        near = (x != y) & (np.bitwise_count(x ^ y) <= max_bits)
        x, y = x[near], y[near]
        if len(x) > 10_000:
            x, y = forest(x, y)
        out_a.append(x)
        out_b.append(y)
        done = to
    if not out_a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    return forest(a, b) if len(a) > 10_000 else (a, b)


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = 3, block: int = 4096) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct
    fingerprints that differ in at most ``max_bits`` bits."""
    rows = look_ups(fps, max_bits, segments)
    hot = materialise(rows.filter("own").groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
                          .filter(F.col("n") > block)
                          .select("part", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "hot")
    n_hot = hot.count()
    if n_hot:
        # both ways of joining give the same rows; the size is known here
        rows = rows.join(F.broadcast(hot) if n_hot <= 10_000 else hot, ["part", "value"], "left")
        own_salt = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
        salts = F.when(F.col("own"), F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).otherwise(F.array(own_salt))
        rows = rows.select("part", "value", "fp", "own", own_salt.alias("own_salt"), F.explode(salts).alias("salt"))
    else:
        rows = rows.withColumns({"own_salt": F.lit(0), "salt": F.lit(0)})
    rows = (rows.select("part", "value", "salt", "fp", "own", (F.col("salt") == F.col("own_salt")).alias("asks"))
                .repartition("part", "value", "salt").sortWithinPartitions("part", "value", "salt"))

    def run(batches):
        held = None
        names = ["part", "value", "salt", "fp", "own", "asks"]

        def solve(cols):
            part, value, salt, fp, own, asks = cols
            if not len(fp):
                return None
            start = np.concatenate([[True], (part[1:] != part[:-1]) | (value[1:] != value[:-1]) | (salt[1:] != salt[:-1])])
            a, b = verified(np.cumsum(start), fp.view(np.uint64), own, asks, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            # the last group may go on in the next batch
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            cut = int(np.argmax(last))
            out = solve([c[:cut] for c in cols])
            if out is not None and out.num_rows:
                yield out
            held = [c[cut:] for c in cols]
        if held is not None:
            out = solve(held)
            if out is not None:
                yield out

    return rows.mapInArrow(run, "a long, b long")


# -------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """(a, b): every linked node but the least of its component, and that
    least node.  Alternating large-star and small-star rounds until nothing
    changes; the number of rounds grows with the logarithm of the graph."""
    def mark(e):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    e = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = mark(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        e = materialise(small, "small-star")
        new = mark(e)
        if new == state:
            return e
        state = new


def groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, segments: int = 3) -> DataFrame:
    """Document key, fp, root (the least fingerprint of the component) and
    component_id (its smallest doc_id), one row a document."""
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min(KEY_ID).alias("least_id"))
    labels = components(links(nodes, max_bits, segments))
    rooted = (nodes.join(labels.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
                   .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    place = materialise(rooted.join(least, "root").select("fp", "root", "component_id"), "components")
    return rows.join(place, "fp")


def dedup(docs: DataFrame, **options) -> DataFrame:
    """One document of each group: that of the smallest doc_id (null last)."""
    g = groups(docs, **options)
    first = F.min(F.struct(F.col(KEY_ID).isNull(), F.col(KEY_ID), F.col(KEY_HASH))).alias("first")
    kept = g.groupBy("root").agg(first).select(f"first.{KEY_ID}", f"first.{KEY_HASH}")
    return keep_rows(docs, kept)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = groups(read_table(spark, sf_dir, "documents"))
    return g.select(F.col(KEY_ID).alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
