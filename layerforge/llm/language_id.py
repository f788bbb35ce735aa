"""Language identification by cross-parsing.

For each language a suffix automaton of labelled text accepts exactly its
substrings.  A text is parsed against each language: from each position the
longest match is one phrase, and the next phrase starts behind it (a letter
that the language never has is a phrase of its own).  A language that was fitted
on more text matches longer, so phrases are weighted by the logarithm of the
fitted text's length; the language with the least weighted phrases wins.

Fitting takes a bounded sample of labelled rows: for each language the
``sample_docs`` documents of the least hash of (doc_id, text), and
``sample_chars`` characters of each from a place that the hash picks.  So the
driver gets at most that much text for each language, and one automaton (a table
of two states a character, one column a symbol) is a few MB.  The parse itself
covers every character of every text.

Texts are lower-cased; a run of anything but letters is one space.  The parse
works on blocks of ``BLOCK`` symbols that all advance in step through the
automaton's table, one numpy operation for the n-th symbol of all blocks.  A
phrase ends at the end of its block, in all languages alike.

Defined results
---------------
* null texts and texts without a letter: ``und``, score 0.  So is every text
  if nothing was learned.
* Ties go to the language that sorts first.
* score: the winner's share when languages are weighted by the reciprocal of
  their phrases, squared; between 1/n and 1 for n languages.
* Rows without a language teach nothing and are predicted like any other.
  Repeated rows are predicted alike.  An empty table gives no rows.
* Prediction reads the text only.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import KEY_HASH, KEY_ID, doc_key, read_table, worker_cache

SAMPLE_DOCS, SAMPLE_CHARS, BLOCK = 48, 768, 256
UNKNOWN = "und"
#: Texts in one numpy pass.
ROWS = 2000

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str) -> str:
    """Lower case; each run of anything but letters is one space."""
    text = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if text and not text.replace(" ", "").isalpha():       # numbers such as U+00BD and U+2167 are word characters, too
        text = " ".join("".join(c if c.isalpha() else " " for c in text).split())
    return text


def suffix_automaton(codes: list[int], symbols: int) -> np.ndarray:
    """Transition table of the automaton of all substrings: row = state (1 is
    the start), column = symbol, 0 = no such substring.  Row 0 is left empty."""
    link, size, nxt = [0, 0], [0, 0], [{}, {}]
    last = 1
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        size.append(size[last] + 1)
        link.append(1)
        p = last
        while p and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p:
            q = nxt[p][c]
            if size[q] == size[p] + 1:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = twin
                while p and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
        last = cur
    table = np.zeros((len(nxt), symbols), np.int32)
    for s, arcs in enumerate(nxt):
        for c, t in arcs.items():
            table[s, c] = t
    return table


class Model:
    """Automata of all languages over one alphabet.  Symbol 0 pads blocks,
    symbol 1 is any character that no sample has."""

    def __init__(self, samples: dict[str, list[str]]):
        texts = {k: [normal(t) for t in v] for k, v in sorted(samples.items())}
        texts = {k: [t for t in v if t] for k, v in texts.items()}
        texts = {k: v for k, v in texts.items() if v}
        letters = sorted(set("".join(x for v in texts.values() for x in v)))
        self.alphabet = np.array([ord(c) for c in letters], np.uint32)
        self.symbols = len(letters) + 2
        code = {c: i + 2 for i, c in enumerate(letters)}
        self.languages = list(texts)
        self.tables, self.weights = [], []
        for name in self.languages:
            codes = []
            for t in texts[name]:
                codes += [code[c] for c in t] + [1]        # no phrase runs over two samples
            table = suffix_automaton(codes[:-1], self.symbols)
            table[:, 1] = 0
            self.tables.append(np.ascontiguousarray(table).reshape(-1))
            self.weights.append(float(np.log2(len(codes) + 1)))

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(self.alphabet):
            return np.ones(len(points), np.int32)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 2, 1).astype(np.int32)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text (row) in each language (column)."""
        lengths = np.array([len(t) for t in texts], np.int64)
        blocks = -(-lengths // BLOCK)
        grid = np.zeros((int(blocks.sum()), BLOCK), np.int32)
        codes = self.encode("".join(texts))
        owner = np.repeat(np.arange(len(texts)), blocks)
        first = np.concatenate([[0], np.cumsum(blocks)])[:-1]
        inside = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        grid.reshape(-1)[np.repeat(first * BLOCK, lengths) + inside] = codes
        # full blocks first, so that each step works on a prefix of the rows
        used = np.minimum(BLOCK, np.repeat(lengths, blocks) - (np.arange(len(grid)) - first[owner]) * BLOCK)
        order = np.argsort(-used, kind="stable")
        steps = np.ascontiguousarray(grid[order].T)
        active = np.searchsorted(-used[order], -np.arange(BLOCK), "left")
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        for k, table in enumerate(self.tables):
            state = np.ones(len(grid), np.int32)
            count = np.ones(len(grid), np.int32)           # the first phrase of each block
            width = np.int32(self.symbols)
            for j in range(BLOCK):
                n = active[j]
                if not n:
                    break
                s, c = state[:n], steps[j, :n]
                to = table.take(s * width + c)
                ended = to == 0
                # a new phrase starts with this symbol; if even that has no match it is a phrase alone
                begin = table[width + c[ended]]
                count[:n] += ended & (s != 1)
                alone = begin == 0
                if alone.any():
                    where = np.nonzero(ended)[0][alone]
                    count[where] += 1
                    begin[alone] = 1
                to[ended] = begin
                state[:n] = to
            count -= (state == 1) & (count > 1)            # nothing followed a symbol that stood alone
            out[:, k] = np.bincount(owner, count[np.argsort(order)], len(texts)).astype(np.int64) if len(owner) else 0
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        plain = [normal(t) if t else "" for t in texts]
        found, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(plain) if t]
        if not known or not self.languages:
            return found, score
        cost = self.phrases([plain[i] for i in known]) * np.array(self.weights)
        best = cost.argmin(1)
        share = 1.0 / cost ** 2
        share /= share.sum(1, keepdims=True)
        for row, (i, b) in enumerate(zip(known, best.tolist())):
            found[i] = self.languages[b]
            score[i] = share[row, b]
        return found, score


def crc32_of(col: Column) -> Column:
    """crc32 of a number written as text."""
    return F.crc32(col.cast("string").cast("binary"))


def labelled_samples(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """language -> sample texts, from rows (text, lang).  ``row_number`` up to a
    limit is pushed below the shuffle, so each task sends ``sample_docs`` rows
    a language at most."""
    rank = F.xxhash64(KEY_ID, KEY_HASH)
    n = F.length("text")
    start = F.pmod(rank, F.greatest(n - sample_chars, F.lit(0)) + 1).cast("int") + 1
    rows = (labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
            .select("lang", rank.alias("rank"), F.substring(F.col("text"), start, F.lit(sample_chars)).alias("part")))
    first = Window.partitionBy("lang").orderBy("rank", "part")
    rows = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample_docs)
    out: dict[str, list[str]] = {}
    for r in sorted(rows.select("lang", "n", "part").collect()):
        out.setdefault(r["lang"], []).append(r["part"])
    return out


def model_of(samples: dict[str, list[str]]) -> Model:
    """The model, fitted once a worker."""
    cache, key = worker_cache(), ("language", tuple((k, tuple(v)) for k, v in sorted(samples.items())))
    if key not in cache:
        cache[key] = Model(samples)
    return cache[key]


def predict(docs: DataFrame, samples: dict[str, list[str]]) -> DataFrame:
    """Document key, lang_pred and score."""
    def run(batches):
        model = model_of(samples)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                lang, score = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(lang, pa.string()), pa.array(score)],
                                                 names=[KEY_ID, KEY_HASH, "lang_pred", "score"])
    return docs.select(*doc_key(), "text").mapInArrow(run, f"{KEY_ID} long, {KEY_HASH} long, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(crc32_of(F.col(KEY_ID)), F.lit(5)) == 0, F.lit(False))
    learn = docs.select(*doc_key(), F.col("lang").cast("string").alias("lang"), "text").filter(~held_out)
    samples = labelled_samples(learn)
    return predict(docs, samples).select(F.col(KEY_ID).alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")
