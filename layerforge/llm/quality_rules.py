"""Quality rules: base counts and a robust multivariate outlier test.

Every document is reduced to a short vector of transformed counts.  For each
(language, source) the minimum covariance determinant (MCD) estimate gives the
centre and scatter of the densest ``support`` share of its documents, and a
document is rejected when its Mahalanobis distance from that centre is beyond
a chi-square quantile.  Junk cannot pull the estimates towards itself as long
as it is less than ``1 - support`` of a group.

How the estimate is found at scale
----------------------------------
FAST-MCD's concentration step needs the mean and covariance of the h documents
nearest to the current centre.  One aggregation gives it: rows are counted and
their moments summed by (group, distance bin), with partial sums before the
shuffle; the bins up to the one in which the count reaches h are added up.  A
group of any size is thus a few hundred rows by the time it meets in one task.
The subset ends at a bin edge (bins are 1/16 of an octave of squared distance
wide), so it holds h documents or a few more.  The start is deterministic:
the median and the interquartile range of each statistic by group, from
histograms.

Defined results
---------------
* null text: no words, all counts zero, base_failed, not kept.
* null language or source: a group of its own, like any other value.
* Documents that fail the base rules take no part in the estimates.
* Every (language, source) has an estimate of its own at every size.  Its
  centre and scatter are drawn towards those of its language, and those of the
  language towards those of all documents, with a weight that depends smoothly
  on the group's documents: n / (n + ``prior``) for its own, the rest for the
  wider group's.  So a few documents can neither make a narrow estimate nor
  vouch for each other, and no size switches from one estimate to another.
* A document of a group in which all fail the base rules has no distance.
* repeated rows count as often as they occur; ties in distance fall in the
  same bin, so they are in or out together.
* Columns other than doc_id, text, lang and source are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY_HASH, KEY_ID, arrow_map, doc_key, keep_rows, materialise, read_table

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# classes of bytes, for one lookup and one count a text
_SPACE, _SYMBOL, _UPPER, _DIGIT, _PUNCT, _LETTER, _TAIL = range(7)


def _byte_classes() -> np.ndarray:
    t = np.full(256, _LETTER, np.uint8)
    for b in range(128):
        c = chr(b)
        if c in " \t\n\v\f\r":
            t[b] = _SPACE
        elif b in SYMBOLS:
            t[b] = _SYMBOL
        elif c.isupper():
            t[b] = _UPPER
        elif c.isdigit():
            t[b] = _DIGIT
        elif not c.isalpha():
            t[b] = _PUNCT
    t[128:192] = _TAIL        # continuation bytes: no character of their own
    return t


_CLASSES = _byte_classes()

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_punct"]


def repeated_words(words: list[bytes]) -> int:
    """Words covered by a 3-word window that is found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size = len(number) + 1
    pair = ids[:-1] * size + ids[1:]
    if size >= 2_000_000:                      # three ids would not fit 64 bits
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair[:-1] * size + ids[2:]
    order = np.argsort(window, kind="stable")
    s = window[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def count_text(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    raw = text.encode()
    words = raw.split()                        # on ASCII white space only
    by = np.bincount(_CLASSES[np.frombuffer(raw, np.uint8)], minlength=7) if raw else np.zeros(7, np.int64)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return (len(words), len(text) - int(by[_SPACE]), int(by[_SYMBOL]), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), int(by[_UPPER]), int(by[_DIGIT]), int(by[_PUNCT]))


def base_counts(docs: DataFrame) -> DataFrame:
    """Document key, lang, source and the counts of every document."""
    keyed = docs.select(*doc_key(), F.col("lang").cast("string"), F.col("source").cast("string"), "text")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [count_text(t.as_py() or "") for t in batch.column("text")]
        table = np.array(rows, np.int64).reshape(-1, len(COUNTS))
        return pa.RecordBatch.from_arrays(
            batch.columns[:4] + [pa.array(table[:, k]) for k in range(len(COUNTS))],
            names=[KEY_ID, KEY_HASH, "lang", "source", *COUNTS])

    schema = f"{KEY_ID} long, {KEY_HASH} long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    return arrow_map(keyed, count, schema)


# ------------------------------------------------------- the outlier test

#: The transformed statistics, and for each the spread below which a
#: difference is no evidence of junk.  Its square is added to the scatter, so
#: statistics that are constant in a group (no symbols at all) do not make the
#: scatter singular or a single symbol an outlier.  Those of the two shares are
#: small against the angles that the base rules leave (0.785 for 50 %), so
#: either can reject by itself.
FLOORS = {"x_word_length": 0.06, "x_symbols": 0.4, "x_dup_lines": 0.12, "x_repeats": 0.12}
#: Lines and words that are added to those of a document before its shares are
#: taken: one repeated line of three is little evidence, 23 of 60 are much.
PRIOR_LINES, PRIOR_WORDS = 6, 100
VECTOR = list(FLOORS)
DIM = len(VECTOR)
PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
BINS = 640
#: Documents that the wider group's estimate counts for: some seven for each of
#: the 14 numbers of a centre and a scatter.
PRIOR_DOCS = 100


def transformed() -> dict[str, Column]:
    """Logs of rates, and the angle that evens out the variance of a share.
    Shares are drawn towards 0 in short documents."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")

    def angle(part, whole):
        return F.asin(F.sqrt(F.least(F.lit(1.0), part / whole)))
    return {
        "x_word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x_symbols": F.log1p(F.col("n_symbols") / n / 0.02),
        "x_dup_lines": angle(F.col("n_dup_lines"), (F.col("n_lines") + PRIOR_LINES).cast("double")),
        "x_repeats": angle(F.col("n_repeat_words"), n + PRIOR_WORDS),
    }


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function for even k."""
    term, total = 1.0, 1.0
    for i in range(1, k // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - float(np.exp(-x / 2)) * total


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def consistency(support: float) -> float:
    """What the covariance of the nearest ``support`` share must be multiplied
    by to estimate that of a normal sample."""
    return support / chi2_cdf(chi2_quantile(support, DIM), DIM + 2)


def with_vector(counts: DataFrame, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Adds base_failed, the transformed statistics and the keys of the three
    groups that a document belongs to (source, language, all)."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return counts.select(
        "*", failed.alias("base_failed"), *[c.alias(n) for n, c in transformed().items()],
        F.concat(F.lit("2"), F.to_json(F.struct("lang", "source"))).alias("g2"),
        F.concat(F.lit("1"), F.to_json(F.struct("lang"))).alias("g1"), F.lit("0").alias("g0"))


def distance(mean: str = "mean", inverse: str = "inverse") -> Column:
    """Squared Mahalanobis distance of the row's vector."""
    dev = [F.col(x) - F.col(mean)[i] for i, x in enumerate(VECTOR)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + dev[i] * dev[j] * F.col(inverse)[i * DIM + j] * (1 if i == j else 2)
    return total


ESTIMATE = "g string, n long, mean array<double>, scatter array<double>, inverse array<double>"


def _inverse(scatter: np.ndarray) -> np.ndarray:
    return np.linalg.inv(scatter + np.diag([f * f for f in FLOORS.values()]))


def _estimate(g: str, n: int, mean: np.ndarray, scatter: np.ndarray) -> tuple:
    return g, n, mean.tolist(), scatter.reshape(-1).tolist(), _inverse(scatter).reshape(-1).tolist()


def start_estimates(rows: DataFrame) -> DataFrame:
    """Median and interquartile range of every statistic by group, from
    histograms with 128 bins to a unit (4,096 in all; the statistics are
    logarithms and angles, which lie within -8 and 24)."""
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("stat"), F.col(x).alias("x")) for i, x in enumerate(VECTOR)]))
    bin_ = F.greatest(F.least(F.floor(128 * F.col("v.x")) + 1024, F.lit(4095)), F.lit(0)).cast("int")
    counts = (rows.select("g", values.alias("v")).groupBy("g", F.col("v.stat").alias("stat"), bin_.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))

    def finish(key, table):
        stat, at, n = (table.column(c).to_numpy() for c in ("stat", "bin", "n"))
        quartiles, total = np.empty((DIM, 3)), 0
        for i in range(DIM):
            order = np.nonzero(stat == i)[0][np.argsort(at[stat == i])]
            up = np.cumsum(n[order])
            total = int(up[-1])
            place = np.searchsorted(up, np.ceil(np.array([0.25, 0.5, 0.75]) * total))
            quartiles[i] = (at[order][place] - 1024 + 0.5) / 128
        scale = (quartiles[:, 2] - quartiles[:, 0]) / 1.349
        return pa.Table.from_batches([_estimates_batch([_estimate(key[0].as_py(), total, quartiles[:, 1], np.diag(scale ** 2))])])
    return counts.groupBy("g").applyInArrow(finish, ESTIMATE)


def _estimates_batch(rows: list[tuple]) -> pa.RecordBatch:
    g, n, *values = zip(*rows) if rows else ((), (), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(g, pa.string()), pa.array(n, pa.int64()), *[pa.array(v, pa.list_(pa.float64())) for v in values]],
        names=["g", "n", "mean", "scatter", "inverse"])


def concentrate(rows: DataFrame, estimates: DataFrame, support: float) -> DataFrame:
    """One concentration step: estimates from the nearest ``support`` share."""
    d2 = rows.join(estimates, "g").select("g", *VECTOR, distance().alias("d2"))
    bin_ = F.least(F.greatest(F.floor(16 * F.log2(F.col("d2") + 1e-9)) + 480, F.lit(0)), F.lit(BINS - 1))
    sums = (d2.groupBy("g", bin_.cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(VECTOR)],
                   *[F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"p{i}{j}") for i, j in PAIRS]))
    factor = consistency(support)

    def finish(key, table):
        t = table.sort_by("bin")
        n = t.column("n").to_numpy()
        take = int(np.searchsorted(np.cumsum(n), np.ceil(support * n.sum()))) + 1
        h = n[:take].sum()
        mean = np.array([t.column(f"s{i}").to_numpy()[:take].sum() for i in range(DIM)]) / h
        scatter = np.empty((DIM, DIM))
        for i, j in PAIRS:
            scatter[i, j] = scatter[j, i] = t.column(f"p{i}{j}").to_numpy()[:take].sum() / h - mean[i] * mean[j]
        return pa.Table.from_batches([_estimates_batch([_estimate(key[0].as_py(), int(n.sum()), mean, factor * scatter)])])
    return sums.groupBy("g").applyInArrow(finish, ESTIMATE)


def estimates(vectors: DataFrame, support: float = 0.75, steps: int = 4) -> DataFrame:
    """The MCD estimate of every group at all three levels (a written table
    of one row a group)."""
    rows = (vectors.filter(~F.col("base_failed"))
                   .select(F.explode(F.array("g2", "g1", "g0")).alias("g"), *VECTOR))
    found = materialise(start_estimates(rows), "mcd-start")
    for k in range(steps):
        found = materialise(concentrate(rows, found, support), f"mcd-{k}")
    return found


def drawn(found: DataFrame, wider: DataFrame, prior: int = PRIOR_DOCS) -> DataFrame:
    """The estimates of every (language, source), drawn towards those of its
    language and of all documents: g2, mean and inverse, one row a group.
    ``wider`` has the keys g2, g1 and g0 of each."""
    def level(k):
        return found.select(F.col("g").alias(f"g{k}"), *[F.col(c).alias(f"{c}{k}") for c in ("n", "mean", "scatter")])
    nested = wider.join(level(2), "g2").join(level(1), "g1").join(level(0), "g0")

    def blend(batch):
        n = {k: batch.column(f"n{k}").to_numpy() for k in (1, 2)}
        mean, scatter = ({k: np.array(batch.column(f"{c}{k}").to_pylist()) for k in (0, 1, 2)} for c in ("mean", "scatter"))
        m, v = mean[0], scatter[0]
        for k in (1, 2):
            w = (n[k] / (n[k] + prior))[:, None]
            m, v = w * mean[k] + (1 - w) * m, w * scatter[k] + (1 - w) * v
        inverse = [_inverse(x.reshape(DIM, DIM)).reshape(-1).tolist() for x in v]
        return pa.RecordBatch.from_arrays(
            [batch.column("g2"), pa.array(m.tolist(), pa.list_(pa.float64())), pa.array(inverse, pa.list_(pa.float64()))],
            names=["g2", "mean", "inverse"])
    return arrow_map(nested, blend, "g2 string, mean array<double>, inverse array<double>")


def verdicts(docs: DataFrame, support: float = 0.75, steps: int = 4, reject: float = 1e-5,
             prior: int = PRIOR_DOCS) -> DataFrame:
    """Document key, counts, base_failed, squared distance (null if there is no
    estimate) and kept, one row a document.  ``reject`` is the share of clean
    documents that the cut-off is laid out to reject, ``prior`` the documents
    that the wider group's estimate counts for."""
    vectors = materialise(with_vector(base_counts(docs)), "quality")
    found = drawn(estimates(vectors, support, steps), vectors.select("g2", "g1", "g0").distinct(), prior)
    cut = chi2_quantile(1 - reject, DIM)
    return (vectors.join(found, "g2", "left").withColumn("distance2", distance())
               .select(KEY_ID, KEY_HASH, F.col(KEY_ID).alias("doc_id"), "lang", "source", *COUNTS, "base_failed", "distance2",
                       (~F.col("base_failed") & F.coalesce(F.col("distance2") <= cut, F.lit(True))).alias("kept")))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, columns unchanged."""
    return keep_rows(docs, verdicts(docs, **options).filter("kept"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = verdicts(read_table(spark, sf_dir, "documents"))
    return v.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "distance2")
