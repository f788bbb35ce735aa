"""Edit-aware token counts.

Each document keeps a segment tree.  A leaf stands for up to ``LEAF`` pieces
(see ``pieces``: whole pre-tokens, cut where a token always starts), and every
node holds the characters and tokens below it.  An edit finds its leaves by
descending the character sums.  The region to encode again is the touched
leaves, widened to the next leaf starts whose three characters (the one before,
the space, the one behind) the edit leaves alone: such a start is one in the
new text too, so what lies outside the region keeps its tokens.  The region's
pieces are dealt to the leaves that it covered, and the sums above them are
brought up to date.  When a leaf has grown to ``GROWN`` times its size, the
tree is laid out anew from the counts at hand.

Trees are columns of a table, in heap order (node 1 is the root, node k has
children 2k and 2k + 1), so a table of trees can be written, read and edited
again.

Defined results
---------------
* Counts are those of encoding the whole text, ordinary text only (the string
  of a special token is not special).
* null texts are empty ones: a tree without leaves, no tokens.
* An edit's start and length are clipped to the text; a null start is 0, a null
  length 0, a null insertion empty, a null edit does nothing.  The edits of a
  document apply one after the other, each to the text that the last one left.
* Edits of an unknown document are ignored; documents without edits stay.
* Rows of one doc_id all get its edits.  Columns other than those named are not
  read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import KEY_ID, materialise, read_table
from .pieces import Counts, counts, split_pieces, vocabulary_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF, GROWN = 16, 8


class Tree:
    """Segment tree over the leaves of one text."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.cap = len(chars) // 2

    @classmethod
    def of_leaves(cls, chars: list[int], tokens: list[int]) -> "Tree":
        cap = 1 << max(len(chars) - 1, 0).bit_length()
        out = []
        for leaves in (chars, tokens):
            tree = np.zeros(2 * cap, np.int32)
            tree[cap:cap + len(leaves)] = leaves
            width = cap
            while width > 1:
                tree[width // 2:width] = tree[width:2 * width].reshape(-1, 2).sum(1)
                width //= 2
            out.append(tree)
        return cls(*out)

    def total(self) -> int:
        return int(self.tokens[1])

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf starts; beyond
        the text the last leaf that is not empty."""
        char = min(char, int(self.chars[1]) - 1)
        node, start = 1, 0
        while node < self.cap:
            left = int(self.chars[2 * node])
            node *= 2
            if char >= start + left:
                start += left
                node += 1
        return node - self.cap, start

    def put(self, first: int, chars: list[int], tokens: list[int]) -> None:
        """Replace consecutive leaves and update the sums above them."""
        lo, hi = self.cap + first, self.cap + first + len(chars) - 1
        self.chars[lo:hi + 1] = chars
        self.tokens[lo:hi + 1] = tokens
        while lo > 1:
            lo, hi = lo // 2, hi // 2
            for tree in (self.chars, self.tokens):
                tree[lo:hi + 1] = tree[2 * lo:2 * hi + 2].reshape(-1, 2).sum(1)


def measure(text: str, leads: bool, count: Counts) -> tuple[list[int], list[int]]:
    """Characters and tokens of each piece; ``leads`` if the text is a document's
    beginning (else it starts with the space of its first piece)."""
    if not text:
        return [], []
    if leads:
        pieces = split_pieces(text)
        head = [count.first(pieces[0])]
        return [len(pieces[0])] + [len(p) + 1 for p in pieces[1:]], head + [count[p] for p in pieces[1:]]
    pieces = split_pieces(text[1:])
    return [len(p) + 1 for p in pieces], [count[p] for p in pieces]


def grouped(values: list[int], groups: int) -> list[int]:
    """Sums of ``groups`` even runs of the values (0 for empty runs)."""
    n = len(values)
    edges = [n * k // groups for k in range(groups + 1)]
    return [sum(values[a:b]) for a, b in zip(edges, edges[1:])]


def build_tree(text: str, count: Counts) -> Tree:
    chars, tokens = measure(text, True, count)
    groups = -(-len(chars) // LEAF) or 1
    return Tree.of_leaves(grouped(chars, groups), grouped(tokens, groups))


def starts_piece(text: str, at: int) -> bool:
    """Whether a token always starts at ``at``: a space between two others."""
    return (0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace())


def edit_tree(tree: Tree, text: str, start: int, length: int, insert: str, count: Counts) -> tuple[Tree, str, int]:
    """The tree and text after an edit, and how many characters were encoded."""
    n = len(text)
    start = min(max(start, 0), n)
    end = min(start + max(length, 0), n)
    if start == end and not insert:
        return tree, text, 0
    new = text[:start] + insert + text[end:]
    if not n:
        return build_tree(new, count), new, len(new)
    # the last leaf start a with a + 2 <= start, or the beginning
    first, a = tree.leaf_at(max(start - 2, 0))
    while a > 0 and not (a + 2 <= start and starts_piece(text, a)):
        first, a = tree.leaf_at(a - 1)
    # the next leaf start b with b - 1 >= end, or the end
    last, at = tree.leaf_at(min(end, n - 1))
    b = at + int(tree.chars[tree.cap + last])
    while b < n and not (b - 1 >= end and starts_piece(text, b)):
        last, at = tree.leaf_at(b)
        b = at + int(tree.chars[tree.cap + last])
    region = new[a:b + len(new) - n]
    chars, tokens = measure(region, a == 0, count)
    slots = last - first + 1
    if len(chars) > GROWN * LEAF * slots:
        old = slice(tree.cap, tree.cap + first), slice(tree.cap + last + 1, 2 * tree.cap)
        groups = -(-len(chars) // LEAF)
        keep = [[int(x) for x in t[old[0]]] for t in (tree.chars, tree.tokens)]
        rest = [(int(c), int(t)) for c, t in zip(tree.chars[old[1]], tree.tokens[old[1]]) if c]
        return Tree.of_leaves(keep[0] + grouped(chars, groups) + [c for c, _ in rest],
                              keep[1] + grouped(tokens, groups) + [t for _, t in rest]), new, len(region)
    tree.put(first, grouped(chars, slots), grouped(tokens, slots))
    return tree, new, len(region)


TREES = f"{KEY_ID} long, text string, chars array<int>, tokens array<int>"


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(arrays) if arrays else np.empty(0, np.int32))


def build(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The trees of all documents: id, text, chars and tokens (heap order)."""
    path = path or vocabulary_path(VOCABULARY)

    def run(batches):
        count = counts(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [t or "" for t in part.column("text").to_pylist()]
                trees = [build_tree(t, count) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(KEY_ID), pa.array(texts, pa.string()), _lists([t.chars for t in trees]),
                     _lists([t.tokens for t in trees])], names=[KEY_ID, "text", "chars", "tokens"])
    return docs.select(F.col("doc_id").cast("long").alias(KEY_ID), "text").mapInArrow(run, TREES)


def totals(trees: DataFrame) -> DataFrame:
    """Tokens of each document: the root of its tree."""
    return trees.select(F.col(KEY_ID).alias("doc_id"), F.element_at("tokens", 2).cast("long").alias("n_tokens"))


EDITED = TREES + ", n_before long, n_after long, n_encoded long"


def apply_edits(trees: DataFrame, path: str | None = None) -> DataFrame:
    """Trees after the edits in the column ``edits`` (array of struct of start,
    length, insert), with the counts before and after and the characters that
    were encoded again."""
    path = path or vocabulary_path(VOCABULARY)

    def run(batches):
        count = counts(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, rows = part.column(KEY_ID), []
                flat = [part.column(c).flatten().to_numpy() for c in ("chars", "tokens")]
                ends = [np.concatenate([[0], np.cumsum(part.column(c).value_lengths().to_numpy())]) for c in ("chars", "tokens")]
                for k, (text, edits) in enumerate(zip(part.column("text").to_pylist(), part.column("edits").to_pylist())):
                    tree = Tree(*[f[e[k]:e[k + 1]].copy() for f, e in zip(flat, ends)])
                    before, encoded = tree.total(), 0
                    for e in edits or []:
                        if e:
                            tree, text, n = edit_tree(tree, text, e["start"] or 0, e["length"] or 0, e["insert"] or "", count)
                            encoded += n
                    rows.append((text, tree, before, encoded))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([r[0] for r in rows], pa.string()), _lists([r[1].chars for r in rows]),
                     _lists([r[1].tokens for r in rows]), pa.array([r[2] for r in rows], pa.int64()),
                     pa.array([r[1].total() for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                    names=[KEY_ID, "text", "chars", "tokens", "n_before", "n_after", "n_encoded"])
    return trees.select(KEY_ID, "text", "chars", "tokens", "edits").mapInArrow(run, EDITED)


def apply_log(trees: DataFrame, log: DataFrame, path: str | None = None, per_round: int = 1000) -> DataFrame:
    """Trees after an edit log (doc_id, seq, start, length, insert).  Edits are
    gathered by document, ``per_round`` at a time; a document with more takes
    more rounds, each written, so no row grows with the log."""
    numbered = materialise(
        log.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("seq", "start", "length", "insert")))
           .select(F.col("doc_id").cast("long").alias("d"), F.floor((F.col("n") - 1) / per_round).alias("round"), "n",
                   "start", "length", "insert"), "edit-log")
    rounds = numbered.agg(F.max("round")).first()[0]
    for k in range(0 if rounds is None else rounds + 1):
        edits = (numbered.filter(F.col("round") == k).groupBy("d")
                 .agg(F.array_sort(F.collect_list(F.struct("n", "start", "length", "insert"))).alias("edits")))
        edited = apply_edits(trees.join(edits, trees[KEY_ID] == edits["d"], "left"), path)
        trees = materialise(edited.select(KEY_ID, "text", "chars", "tokens"), f"trees-{k}")
    return trees


def derived_edits(text: Column, doc_id: Column, n: int = 3) -> Column:
    """A log for a document, made from its own text: at places that a hash
    picks, up to 40 characters give way to up to 60 from elsewhere in it."""
    size = F.length(text) + 1

    def edit(k):
        at = lambda salt, most: F.pmod(F.xxhash64(doc_id, text, k, F.lit(salt)), most.cast("long")).cast("int")
        return F.struct(at(1, size).alias("start"), at(2, F.lit(41)).alias("length"),
                        F.substring(text, at(3, size) + 1, at(4, F.lit(61))).alias("insert"))
    return F.transform(F.sequence(F.lit(1), F.lit(n)), edit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = build(read_table(spark, sf_dir, "documents"))
    edited = apply_edits(trees.withColumn("edits", derived_edits(F.col("text"), F.col(KEY_ID))))
    return edited.select(F.col(KEY_ID).alias("doc_id"), "n_before", "n_after", "n_encoded",
                         F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
