"""Length buckets that minimise padding, and token-budget batches inside them.

Documents longer than ``max_tokens`` are cut into segments of that length and a
rest.  The histogram of segment lengths over the whole corpus (at most
``max_tokens`` numbers, which is what the driver gets) goes through a dynamic
program that places at most ``buckets`` boundaries so that the padding of all
segments to their bucket's boundary is least.  Inside a bucket of boundary b,
each batch takes floor(budget / b) segments.

Batches are numbered without gathering a bucket: segments are dealt into cells
of about ``cell`` rows by a hash, numbered inside their cell, and shifted by the
number of segments in the bucket's earlier cells.  Each bucket thus has at most
one batch that is not full.

Defined results
---------------
Null and empty texts have no tokens and no segment.  Repeated rows are packed
as often as they occur.  Segments of equal length fall in the same bucket; the
order inside a bucket is that of a hash of the document and the segment, so it
does not depend on partitions.  An empty table gives no rows.  Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import KEY_HASH, KEY_ID, arrow_map, doc_key, materialise, read_table
from .pieces import counter, vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"


def token_lengths(docs: DataFrame, path: str) -> DataFrame:
    """Document key and n_tokens."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        count = counter(path)
        n = [count(t.as_py() or "") for t in batch.column("text")]
        return pa.RecordBatch.from_arrays(batch.columns[:2] + [pa.array(n, pa.int64())],
                                          names=[KEY_ID, KEY_HASH, "n_tokens"])
    return arrow_map(docs.select(*doc_key(), "text"), run, f"{KEY_ID} long, {KEY_HASH} long, n_tokens long")


def length_histogram(lengths: DataFrame, max_tokens: int) -> dict[int, int]:
    """Segment length -> number of segments; at most ``max_tokens`` entries."""
    full = F.floor((F.col("n_tokens") - 1) / max_tokens)
    rows = (lengths.filter("n_tokens > 0")
            .select((F.col("n_tokens") - full * max_tokens).alias("length"), full.alias("full"))
            .groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("full")).collect())
    out = {r["length"]: r["n"] for r in rows}
    cut = sum(r["full"] for r in rows)
    if cut:
        out[max_tokens] = out.get(max_tokens, 0) + cut
    return out


def best_boundaries(histogram: dict[int, int], buckets: int) -> tuple[list[int], int]:
    """Boundaries of at most ``buckets`` buckets, and the least padding."""
    if not histogram:
        return [], 0
    length = np.array(sorted(histogram), np.int64)
    count = np.array([histogram[x] for x in length.tolist()], np.int64)
    m = len(length)
    c = np.concatenate([[0], np.cumsum(count)])
    w = np.concatenate([[0], np.cumsum(count * length)])
    best = length * c[1:] - w[1:]              # one bucket for the first j lengths
    best = np.concatenate([[0], best])
    back = [np.zeros(m + 1, np.int64)]
    for _ in range(min(buckets, m) - 1):
        new, came = best.copy(), np.full(m + 1, -1, np.int64)
        for j in range(2, m + 1):
            total = best[1:j] + length[j - 1] * (c[j] - c[1:j]) - (w[j] - w[1:j])
            i = int(total.argmin())
            if total[i] < new[j]:
                new[j], came[j] = total[i], i + 1
        best, _ = new, back.append(came)
    cuts, j = [], m
    for came in reversed(back):
        if came[j] < 0:                        # one bucket fewer is as good
            continue
        cuts.append(int(length[j - 1]))
        j = int(came[j])
        if not j:
            break
    return sorted(cuts), int(best[m])


def pack(docs: DataFrame, path: str | None = None, max_tokens: int = 4096, buckets: int = 16, budget: int = 65_536,
         cell: int = 4096) -> DataFrame:
    """One row a segment: document key, segment, start and n_tokens (in
    tokens of the document), bucket_tokens (the length it is padded to),
    batch (number within the bucket) and slot (row of the batch)."""
    if budget < max_tokens:
        raise ValueError("budget must hold a segment of max_tokens")
    lengths = materialise(token_lengths(docs, path or vocabulary_path(VOCABULARY)), "lengths")
    histogram = length_histogram(lengths, max_tokens)
    bounds, _ = best_boundaries(histogram, buckets)
    cells = -(-sum(histogram.values()) // cell) or 1
    last = F.floor((F.col("n_tokens") - 1) / max_tokens)
    bound = F.array(*[F.lit(b) for b in bounds or [max_tokens]]).cast("array<long>")
    segments = (lengths.filter("n_tokens > 0")
                .select(KEY_ID, KEY_HASH, "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("segment"))
                .select(KEY_ID, KEY_HASH, "segment", (F.col("segment") * max_tokens).alias("start"),
                        F.least(F.lit(max_tokens).cast("long"), F.col("n_tokens") - F.col("segment") * max_tokens).alias("n_tokens"))
                .withColumn("bucket_tokens", F.element_at(F.filter(bound, lambda b: b >= F.col("n_tokens")), 1))
                .withColumn("order", F.xxhash64(KEY_ID, KEY_HASH, "segment"))
                .withColumn("cell", F.pmod("order", F.lit(cells))))
    before = Window.partitionBy("bucket_tokens").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (segments.groupBy("bucket_tokens", "cell").agg(F.count(F.lit(1)).alias("n"))
               .select("bucket_tokens", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    inside = Window.partitionBy("bucket_tokens", "cell").orderBy("order", KEY_ID, KEY_HASH, "segment")
    capacity = F.floor(F.lit(budget) / F.col("bucket_tokens"))
    return (segments.withColumn("at", F.row_number().over(inside) - 1)
            .join(offsets, ["bucket_tokens", "cell"])
            .withColumn("at", F.col("at") + F.col("offset"))
            .select(KEY_ID, KEY_HASH, "segment", "start", "n_tokens", "bucket_tokens",
                    F.floor(F.col("at") / capacity).alias("batch"), F.pmod(F.col("at"), capacity).alias("slot")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (pack(read_table(spark, sf_dir, "documents"))
            .select(F.col(KEY_ID).alias("doc_id"), "segment", "start", "n_tokens", "bucket_tokens", "batch", "slot"))
