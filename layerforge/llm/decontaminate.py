"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions
only).

A window is ``window`` consecutive words of an item (a shorter item is one
window).  It is treated as the set of its shingles, ``shingle`` words each, with
their offsets.  All shingles of the benchmark are counted over all documents,
and each window is ordered by that rarity.  A document that contains the window
contains all its shingles, so one is a sufficient prefix: the rarest.  Only the
prefix shingles are joined with the documents' positions.  A match at position p
of a shingle with offset o puts the window at p - o; the positional bound drops
places before the first word, the length bound those that end after the last.
What is left is verified word by word in the document.

The documents' side of the join is a position and a hash a word and is read
straight from the scan.  The benchmark's side is broadcast if its measured size
is below ``broadcast_bytes``; beyond it both sides are shuffled by the shingle,
and the places are verified after a join with the documents that have any.

Defined results
---------------
* Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are put in
  lower case.  Null and empty texts have none: such a document is clean, such an
  item has no window.
* A document word is hit if any occurrence of a window covers it; overlapping
  occurrences count a word once.
* Items are told apart by item_id: rows that repeat one are one item with the
  windows of all its rows.  A null item_id is the item of the empty name.
* Equal rows of documents are decided alike, each gets a result.  An empty
  benchmark leaves all documents clean; an empty table gives no rows.
* Only doc_id and text, and item_id and text, are read; other columns of any
  name are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import KEY_HASH, KEY_ID, doc_key, key_equal, keep_rows, materialise, read_table

WINDOW = 10
SHINGLE = 5
#: The benchmark's side of a join is broadcast below this measured size.
BROADCAST_BYTES = 64 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_WORD), F.lit(0))


def _starts(n: Column, length: int) -> Column:
    """0-based starts of all runs of ``length`` among ``n`` words."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The distinct (item, window) pairs; a window is its words joined by one
    space, ``length`` their number."""
    words = (items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("w"))
                  .withColumn("n", F.size("w")).filter("n > 0"))
    runs = F.when(F.col("n") <= window, F.array("w")).otherwise(
        F.transform(_starts(F.size("w"), window), lambda i: F.slice("w", i + 1, window)))
    return (words.select("item", F.explode(runs).alias("w"))
                 .select("item", F.array_join("w", " ").alias("window"), F.size("w").alias("length")).distinct())


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """All shingles of the distinct windows: window, length, offset, size, h."""
    w = windows.select("window", "length").distinct().withColumn("w", F.split("window", " "))
    size = F.least("length", F.lit(shingle))
    return (w.withColumn("size", size)
             .select("window", "length", "size", "w", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("size"))).alias("offset"))
             .select("window", "length", "size", "offset", F.expr("xxhash64(slice(w, offset + 1, size))").alias("h")))


def document_shingles(docs: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """A row for each shingle of each document: key, n (words), size, place, h,
    and what is named in ``keep`` of the array ``w`` of the document's words."""
    rows = (docs.select(*doc_key(), words_of(F.col("text")).alias("w")).withColumn("n", F.size("w")))

    def hashes(size: int) -> Column:
        # "w" is used twice here: used once, its expression would be put into the lambda and run for each word
        return F.transform(_starts(F.size("w"), size), lambda i: F.xxhash64(F.slice("w", i + 1, size)))

    runs = [F.struct(F.lit(s).alias("size"), hashes(s).alias("hashes")) for s in sizes]
    cols = [KEY_ID, KEY_HASH, "n", *keep]
    if len(runs) == 1:
        rows = rows.select(*cols, F.lit(sizes[0]).alias("size"), runs[0]["hashes"].alias("hashes"))
    else:
        rows = rows.select(*cols, F.inline(F.array(*runs)))
    # outer: for an inner one the optimizer adds a filter by the array's size at the scan, which makes the array twice
    return rows.select(*cols, "size", F.posexplode_outer("hashes").alias("place", "h")).filter("h IS NOT NULL")


def _fits(small: DataFrame, row_bytes: Column, limit: int) -> bool:
    """Whether the rows, by their counted bytes, are below ``limit``."""
    return (small.agg(F.sum(row_bytes)).first()[0] or 0) < limit


def occurrences(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All places of all windows in the documents: key, start, stop (0-based
    words, stop excluded), window.  Equal documents share their rows."""
    shingles = materialise(window_shingles(windows, shingle), "shingles")
    sizes = sorted(r[0] for r in shingles.select("size").distinct().collect())     # at most ``shingle`` numbers
    if not sizes:
        return docs.sparkSession.createDataFrame([], f"{KEY_ID} long, {KEY_HASH} long, start int, stop int, window string")
    # rarity: how often each shingle of the benchmark occurs in all documents
    known = shingles.select("size", "h").distinct()
    small = _fits(known, F.lit(16), broadcast_bytes)
    found = document_shingles(docs, sizes).select("size", "h")
    counts = materialise(found.join(F.broadcast(known) if small else known, ["size", "h"], "left_semi" if not small else "inner")
                         .groupBy("size", "h").agg(F.count(F.lit(1)).alias("n_found")), "rarity")
    # the prefix: one shingle of each window, the rarest; a window with one that is nowhere is in no document
    ranked = (shingles.join(counts, ["size", "h"], "left").groupBy("window", "length", "size")
              .agg(F.min(F.struct(F.coalesce("n_found", F.lit(0)).alias("n_found"), "offset", "h")).alias("rarest"))
              .filter("rarest.n_found > 0"))
    prefix = materialise(ranked.select("size", "rarest.h", "rarest.offset", "length", "window"), "prefix")
    start = F.col("place") - F.col("offset")
    in_bounds = (start >= 0) & (start + F.col("length") <= F.col("n"))
    same = F.array_join(F.slice("w", F.col("start") + 1, F.col("length")), " ") == F.col("window")
    if _fits(prefix, F.octet_length("window") + 40, broadcast_bytes):
        places = (document_shingles(docs, sizes, "w").join(F.broadcast(prefix), ["size", "h"]).filter(in_bounds)
                  .select(KEY_ID, KEY_HASH, "w", start.alias("start"), "length", "window"))
        places = places.filter(same)
    else:
        light = materialise(document_shingles(docs, sizes).join(prefix, ["size", "h"]).filter(in_bounds)
                            .select(KEY_ID, KEY_HASH, start.alias("start"), "length", "window").distinct(), "places")
        texts = keep_rows(docs.select("doc_id", "text"), light).dropDuplicates(["doc_id", "text"])
        texts = texts.select(*doc_key(), words_of(F.col("text")).alias("w"))
        places = light.join(texts, key_equal(light, texts)).filter(same).select(light[KEY_ID], light[KEY_HASH], "start", "length", "window")
    return places.select(KEY_ID, KEY_HASH, "start", (F.col("start") + F.col("length")).alias("stop"), "window").distinct()


def _per_document(places: DataFrame, windows: DataFrame) -> DataFrame:
    """key, n_hit (words covered by the places), items (ids, sorted as strings)."""
    by_doc = [KEY_ID, KEY_HASH]
    # the union of intervals: each adds what lies beyond the furthest end before it
    ordered = Window.partitionBy(*by_doc).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = places.select(*by_doc, "start", "stop").distinct()
    hits = (spans.withColumn("reached", F.coalesce(F.max("stop").over(ordered), F.lit(0)))
                 .groupBy(*by_doc).agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reached"))).alias("n_hit")))
    items = (places.select(*by_doc, "window").distinct().join(windows.select("item", "window"), "window")
                   .groupBy(*by_doc).agg(F.sort_array(F.collect_set("item")).alias("items")))
    items = items.select(F.col(KEY_ID).alias("i"), F.col(KEY_HASH).alias("x"), "items")
    return (hits.join(items, F.col(KEY_ID).eqNullSafe(F.col("i")) & F.col(KEY_HASH).eqNullSafe(F.col("x")))
                .select(*by_doc, "n_hit", "items"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row for each document: key, n_words, n_hit, items."""
    windows = materialise(benchmark_windows(items, window), "windows")
    places = materialise(occurrences(docs, windows, shingle, broadcast_bytes), "occurrences")
    rows = docs.select(*doc_key(), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(_WORD_ANY_CASE)).cast("long").alias("n_words"))
    hits = _per_document(places, windows)
    return (rows.join(hits, key_equal(rows, hits), "left")
                .select(rows[KEY_ID], rows[KEY_HASH], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                        F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def drop_contaminated(docs: DataFrame, items: DataFrame, max_hit: int = 0, **options) -> DataFrame:
    """The rows of ``docs`` with at most ``max_hit`` hit words, columns unchanged."""
    clean = contamination(docs, items, **options).filter(F.col("n_hit") <= max_hit)
    return keep_rows(docs, clean.select(KEY_ID, KEY_HASH).distinct())


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return c.select(F.col(KEY_ID).alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bs AS (
  SELECT item, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS l, array_to_string(w[s + 1 : s + 10], ' ') AS t FROM bs
), sizes AS (
  SELECT DISTINCT l FROM win
), ds AS (
  SELECT r, w, l, unnest(range(0, len(w) - l + 1)) AS s FROM d, sizes WHERE len(w) >= l
), hit AS (
  SELECT ds.r, ds.s, ds.l, win.item
  FROM ds JOIN win ON ds.l = win.l AND array_to_string(ds.w[ds.s + 1 : ds.s + ds.l], ' ') = win.t
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + l)) AS p FROM (SELECT DISTINCT r, s, l FROM hit)) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(covered.n_hit, 0) AS n_hit, coalesce(named.n_items, 0) AS n_items,
       sha256(coalesce(named.items, '')) AS items_sha256, coalesce(covered.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON d.r = covered.r LEFT JOIN named ON d.r = named.r
"""
