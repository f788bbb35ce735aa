"""Conversation structure repair by survivor-coalescence Viterbi.

Turns get faults (blank, duplicate, truncated), and each conversation the
cheapest edits after which its roles read ``(s?(ua)+)?``: Keep, Rerole (to user
or assistant), Delete, Insert (an empty turn).  A survivor is the cheapest way to
each state of that pattern (nothing yet, after system, user, assistant).

The edits of the survivors form a tree of backpointers.  A node is referred to
by its children, or by the survivor that it ends; one that loses its last
reference goes, one that is left with a single child is joined with it, and the
part that all survivors share is emitted.  What is held is so what the survivors
still differ in.  Ways of equal cost are compared by their whole unresolved
suffixes: survivors are kept in the order of these, and a way's place follows
from its parent's place, then from its own edits.  (No way is a prefix of
another: each has one edit other than Insert for each turn so far.)  A survivor
that is dearer than another can become by imitating it is dropped, which is what
lets the others coalesce.

A conversation of any length is cut into slices of ``SLICE`` turns, which are
solved apart for every state in which they can be entered; a second pass of the
same survivors over whole slices picks entry and exit of each.  So no task holds
more than a slice and the way of a conversation's slices, whatever its length.

Defined results
---------------
* Turns are ordered by turn (nulls first), then role, then text; repeated rows
  follow each other and are duplicates.  A null role or text is one space, a null
  conv_id is a conversation like any other.
* A turn's first fault counts: blank (only ``[\\x20\\x09-\\x0D]``), duplicate (an
  earlier turn of the conversation has its role and text), truncated (its last
  other character is not one of ``.!?``).
* Delete costs 4 and is the only edit for blank and duplicate turns, Rerole and
  Insert cost 3, a truncated turn that stays 3 more.  Of the cheapest edits the
  least string of their initials wins.  A role of any other initial, or of none,
  cannot be kept.
* A conversation without turns has no edits; an empty table gives no rows.
* Only conv_id, turn, role and text are read; other columns of any name are not.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import numbered
from .common import materialise, read_table

SLICE = 4096
KEY = "_lf_conv"

#: States: nothing yet, after system, after user, after assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: Where a kept turn of an initial leads, and where an inserted or reroled one does.
KEPT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
MADE = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: What ends a conversation in each state.
END = {NONE: (0, b""), SYSTEM: (2 * INSERT, b"I2I3"), USER: (INSERT, b"I3"), ASSISTANT: (0, b"")}
#: IMITATE[r][q]: from r, what follows q costs at most so much more than from q
#: (by one more Insert or Delete, or by the two that end a system turn).
IMITATE = {NONE: {SYSTEM: 0, USER: 3, ASSISTANT: 0}, SYSTEM: {NONE: 6, USER: 3, ASSISTANT: 6},
           USER: {NONE: 7, SYSTEM: 3, ASSISTANT: 3}, ASSISTANT: {NONE: 4, SYSTEM: 0, USER: 3}}


def edit(op: str, state: int) -> bytes:
    """An edit and the state it leads to, two characters."""
    return f"{op}{state}".encode()


def edits_of(initial: str, must_go: bool, truncated: bool) -> dict[int, list[tuple[int, int, bytes]]]:
    """state -> (next state, cost, edits) for one turn; Inserts stand before the
    turn (after a Delete they are less in order, and cost the same)."""
    out = {}
    for p in range(4):
        ways = [(p, DELETE, edit("D", p))]
        if not must_go:
            more, lead = TRUNCATED * truncated, MADE[p]
            for at, cost, before in ((p, more, b""), (lead, more + INSERT, edit("I", lead))):
                if (at, initial) in KEPT:
                    ways.append((KEPT[at, initial], cost, before + edit("K", KEPT[at, initial])))
                ways.append((MADE[at], cost + REROLE, before + edit("R", MADE[at])))
        out[p] = ways
    return out


class Node:
    """Edits that its children, or the survivor that it ends, have in common."""

    __slots__ = ("parent", "children", "edits")

    def __init__(self, parent, edits=b""):
        self.parent, self.children, self.edits = parent, [], bytearray(edits)
        if parent is not None:
            parent.children.append(self)


class Survivors:
    """The cheapest way to each state from one entry state, in order of edits."""

    def __init__(self, entry: int):
        self.root = Node(None)
        self.alive = [(entry, 0, Node(self.root))]

    def step(self, ways: dict[int, list[tuple[int, int, bytes]]]) -> None:
        best: dict[int, tuple[int, int, bytes]] = {}
        for place, (p, cost, _) in enumerate(self.alive):
            for q, more, edits in ways.get(p, ()):
                way = (cost + more, place, edits)
                if q not in best or way < best[q]:
                    best[q] = way
        kept = [(place, edits, q, cost) for q, (cost, place, edits) in best.items()
                if not any(best[r][0] + IMITATE[r][q] < cost for r in best if r != q)]
        kept.sort()
        heirs: dict[int, list] = {}
        for place, edits, q, cost in kept:
            heirs.setdefault(place, []).append((edits, q, cost))
        alive = []
        for place, (_, _, leaf) in enumerate(self.alive):
            ways_on = heirs.get(place, ())
            if not ways_on:
                self._drop(leaf)
            elif len(ways_on) == 1:
                edits, q, cost = ways_on[0]
                leaf.edits += edits
                alive.append((q, cost, leaf))
            else:
                alive += [(q, cost, Node(leaf, edits)) for edits, q, cost in ways_on]
        self.alive = alive

    def _drop(self, leaf: Node) -> None:
        above = leaf.parent
        above.children.remove(leaf)
        if above is not self.root and len(above.children) == 1:
            only = above.children[0]
            above.edits += only.edits
            only.edits, only.parent = above.edits, above.parent
            above.parent.children[above.parent.children.index(above)] = only

    def resolved(self) -> bytes:
        """The edits that all survivors share and that were not emitted yet."""
        out = bytearray()
        while len(self.root.children) == 1:
            only = self.root.children[0]
            out += only.edits
            only.edits = bytearray()
            if not only.children:
                break
            self.root.children = only.children
            for child in only.children:
                child.parent = self.root
        return bytes(out)

    def open_ways(self) -> list[tuple[int, int, bytes]]:
        """(state, cost, unresolved edits) of each survivor, in order."""
        out = []
        for state, cost, node in self.alive:
            parts = []
            while node is not self.root:
                parts.append(bytes(node.edits))
                node = node.parent
            out.append((state, cost, b"".join(reversed(parts))))
        return out


# ---------------------------------------------------------------- turns, faults

def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def keyed(turns: DataFrame) -> DataFrame:
    """The four columns, with nulls filled and a key that is never null."""
    name = F.when(F.col("conv_id").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    return turns.select(name.alias(KEY), "conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"))


def faults(rows: DataFrame) -> DataFrame:
    """key, ordinal, turn, role, text -> key, ordinal, turn, role, fault (or null)."""
    other = r"[^\x20\x09-\x0D]"
    rows = rows.select(KEY, "ordinal", "turn", "role", F.sha2("text", 256).alias("digest"),
                       (~F.col("text").rlike(other)).alias("blank"),
                       (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))
    rows = materialise(rows, "turn-marks")
    # the first of equal turns; joined by place, so that a turn repeated at will is no hot key
    first = rows.groupBy(KEY, "role", "digest").agg(F.min("ordinal").alias("ordinal")).select(KEY, "ordinal", F.lit(True).alias("first"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("truncated"), "truncated"))
    return rows.join(first, [KEY, "ordinal"], "left").select(KEY, "ordinal", "turn", "role", fault.alias("fault"))


# ------------------------------------------------------------------ the edits

_SLICE_ROWS = f"{KEY} string, slice long, entry int, exit int, cost long, place int, edits string, illegal long"


def _solve_slices(batches):
    """Sorted turns of slices -> for each entry a row of the edits that all
    survivors share (exit -1) and one for each survivor."""
    ways, names = {}, [f.split()[0] for f in _SLICE_ROWS.split(", ")]
    at, trees, illegal, before = None, {}, 0, None

    def ended():
        for n, (entry, tree) in enumerate(trees.items()):
            yield (*at, entry, -1, 0, -1, tree.resolved().decode(), illegal if n == 0 else 0)
            for place, (state, cost, edits) in enumerate(tree.open_ways()):
                yield (*at, entry, state, cost, place, edits.decode(), 0)

    for batch in batches:
        out = []
        for key, piece, lead, role, fault in zip(*(batch.column(c).to_pylist() for c in (KEY, "slice", "lead", "role", "fault"))):
            if (key, piece) != at:
                if at is not None:
                    out += ended()
                at, trees, illegal, before = (key, piece), {p: Survivors(p) for p in (range(4) if piece else [NONE])}, 0, None
            initial = role[:1]
            if before is not None:
                illegal += before + initial not in ("su", "ua", "au")
            before = initial
            if lead:
                continue
            kind = (initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated")
            if kind not in ways:
                ways[kind] = edits_of(*kind)
            for tree in trees.values():
                tree.step(ways[kind])
        if out:
            yield _batch(out, names)
    if at is not None:
        yield _batch(list(ended()), names)


def _batch(rows, names) -> pa.RecordBatch:
    kinds = {"slice": pa.int64(), "entry": pa.int32(), "exit": pa.int32(), "cost": pa.int64(), "place": pa.int32(),
             "illegal": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names=names)


_CHOICE_ROWS = f"{KEY} string, slice long, entry int, exit int, cost long, tail string"


def _choose(batches):
    """Sorted slice rows of conversations -> entry and exit of each slice; the
    last one has the conversation's cost and the Inserts at its end."""
    names = [f.split()[0] for f in _CHOICE_ROWS.split(", ")]
    at, tree, piece, done, ways = None, None, -1, 0, {}

    def passed(edits, key, first):
        return [(key, first + i // 3, edits[i + 1], edits[i + 2], None, "") for i in range(0, len(edits), 3)]

    def advance():
        nonlocal ways, done
        if ways:
            tree.step(ways)
            ways = {}
            shared = tree.resolved()
            done += len(shared) // 3
            return passed(shared, at, done - len(shared) // 3)
        return []

    def ended():
        out = advance()
        ends = [(cost + END[state][0], place, state, edits) for place, (state, cost, edits) in enumerate(tree.open_ways())]
        cost, _, state, edits = min(ends)
        out += passed(edits, at, done)
        if edits:
            out[-1] = (*out[-1][:4], cost, END[state][1].decode())
        else:                                     # all slices were emitted before the end was known
            out.append((at, piece, -1, state, cost, END[state][1].decode()))
        return out

    for batch in batches:
        out = []
        for key, no, entry, exit_, cost, place in zip(*(batch.column(c).to_pylist()
                                                        for c in (KEY, "slice", "entry", "exit", "cost", "place"))):
            if key != at:
                if at is not None:
                    out += ended()
                at, tree, piece, done, ways = key, Survivors(NONE), -1, 0, {}
            if no != piece:
                out += advance()
                piece = no
            # a way's place among those from its entry stands for its edits
            ways.setdefault(entry, []).append((exit_, cost, bytes([place, entry, exit_])))
        if out:
            yield _batch(out, names)
    if at is not None:
        yield _batch(ended(), names)


def best_edits(marked: DataFrame, slice_turns: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """From ``faults``: a row for each slice (key, slice, edits), in which an edit
    is its initial and the state after it, and a row for each conversation (key,
    cost, illegal)."""
    at = F.floor(F.col("ordinal") / slice_turns)
    # the last turn of a slice also leads the next one, for the pair of roles across the cut
    both = F.array(at, F.when((F.col("ordinal") + 1) % slice_turns == 0, at + 1))
    rows = (marked.select(KEY, "ordinal", "role", "fault", F.explode(F.array_compact(both)).alias("slice"))
                  .withColumn("lead", F.floor(F.col("ordinal") / slice_turns) < F.col("slice")))
    solved = materialise(rows.repartition(KEY, "slice").sortWithinPartitions(KEY, "slice", "ordinal")
                             .mapInArrow(_solve_slices, _SLICE_ROWS), "slices").filter("entry is not null")
    survivors = solved.filter("exit >= 0").select(KEY, "slice", "entry", "exit", "cost", "place")
    chosen = materialise(survivors.repartition(KEY).sortWithinPartitions(KEY, "slice", "entry", "place")
                                  .mapInArrow(_choose, _CHOICE_ROWS), "chosen")
    shared = solved.filter("exit = -1").select(KEY, "slice", "entry", F.col("edits").alias("shared"))
    rest = solved.filter("exit >= 0").select(KEY, "slice", "entry", "exit", F.col("edits").alias("rest"))
    tails = chosen.filter("cost IS NOT NULL").select(KEY, "slice", "tail", "cost")
    edits = (chosen.filter("entry >= 0").select(KEY, "slice", "entry", "exit")
                   .join(shared, [KEY, "slice", "entry"]).join(rest, [KEY, "slice", "entry", "exit"])
                   .join(tails, [KEY, "slice"], "left")
                   .select(KEY, "slice", F.concat("shared", "rest", F.coalesce("tail", F.lit(""))).alias("edits")))
    totals = (solved.groupBy(KEY).agg(F.sum("illegal").alias("illegal")).join(tails.select(KEY, "cost"), KEY))
    return edits, totals


def repaired(rows: DataFrame, edits: DataFrame, slice_turns: int = SLICE) -> DataFrame:
    """The repaired dialogues: key, ordinal (of the turn, or of the one that an
    inserted turn precedes), sub, edit, role, text."""
    units = edits.select(KEY, "slice", F.posexplode(F.regexp_extract_all("edits", F.lit(r"(?:I.)*[DKR].|(?:I.)+$"), F.lit(0))).alias("i", "unit"))
    steps = units.select(KEY, (F.col("slice") * slice_turns + F.col("i")).alias("ordinal"),
                         F.posexplode(F.regexp_extract_all("unit", F.lit(".."), F.lit(0))).alias("sub", "step"))
    steps = steps.select(KEY, "ordinal", "sub", F.substring("step", 1, 1).alias("edit"),
                         F.when(F.substring("step", 2, 1) == str(USER), "user").otherwise("assistant").alias("made")).filter("edit <> 'D'")
    own = rows.select(KEY, "ordinal", F.col("role").alias("had"), "text")
    kept = F.col("edit") == "K"
    return (steps.join(own, [KEY, "ordinal"], "left")
                 .select(KEY, "ordinal", "sub", "edit", F.when(kept, F.col("had")).otherwise(F.col("made")).alias("role"),
                         F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text")))


def _digests(batches):
    """Sorted turns -> one digest for each conversation; holds one turn at a time."""
    at, digest = None, None
    for batch in batches:
        out = []
        for key, role, text in zip(*(batch.column(c).to_pylist() for c in (KEY, "role", "text"))):
            line = f"{role}:{text}".encode()
            if key != at:
                if at is not None:
                    out.append((at, digest.hexdigest()))
                at, digest = key, hashlib.sha256(line)
            else:
                digest.update(b"\n" + line)
        if out:
            yield _batch(out, [KEY, "sha"])
    if at is not None:
        yield _batch([(at, digest.hexdigest())], [KEY, "sha"])


def repair(turns: DataFrame, slice_turns: int = SLICE) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(turns with their faults, edits by slice, totals, repaired dialogues)."""
    if KEY not in turns.columns:
        turns = keyed(turns)
    rows = materialise(numbered(turns.select(F.col(KEY).alias("conv_id"), "turn", "role", "text"))
                       .withColumnRenamed("conv_id", KEY), "ordered-turns")
    marked = materialise(faults(rows), "faults")
    edits, totals = best_edits(marked, slice_turns)
    edits = materialise(edits, "edits")
    return marked, edits, totals, repaired(rows, edits, slice_turns)


def damage(turns: DataFrame) -> DataFrame:
    """``keyed`` turns with the damage that crc32 of ``conv_id:turn`` selects."""
    fill = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = keyed(turns).withColumn("kind", F.crc32(F.concat(fill("conv_id"), F.lit(":"), fill("turn"))) % 20)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select(KEY, "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str, slice_turns: int = SLICE) -> DataFrame:
    original = read_table(spark, sf_dir, "conversations")
    marked, edits, totals, dialogue = repair(damage(original), slice_turns)
    number = lambda kind: F.count(F.when(F.col("fault") == kind, 1)).alias(kind)
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = marked.groupBy(KEY).agg(F.coalesce(span, F.lit(0)).alias("gaps"), *map(number, ("blank", "duplicate", "truncated")))
    audits = (edits.select(KEY, "slice", F.regexp_replace("edits", "[0-9]", "").alias("initials"))
                   .groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct("slice", "initials"))).alias("parts"))
                   .select(KEY, F.array_join("parts.initials", "").alias("audit")))
    # SHA-256 runs through a conversation in order: sorted, and a turn at a time
    digests = (dialogue.repartition(KEY).sortWithinPartitions(KEY, "ordinal", "sub").select(KEY, "role", "text")
                       .mapInArrow(_digests, f"{KEY} string, sha string"))
    everyone = keyed(original).select(KEY, "conv_id").distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (everyone.join(counts, KEY, "left").join(totals, KEY, "left").join(audits, KEY, "left").join(digests, KEY, "left")
            .select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
