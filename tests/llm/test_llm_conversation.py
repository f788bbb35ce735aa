"""Conversation repair against plain dynamic programming over whole strings."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from layerforge.llm import conversation_repair as C
from tests.llm.conftest import SF

SPACE = " \t\n\x0b\x0c\r"
STEP = {"": "su", "s": "u", "u": "a", "a": "u"}


def slow_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        t = text.strip(SPACE)
        out.append("blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def slow_repair(rows):
    """(cost, audit, repaired turns): least (cost, audit) over all edits, any
    number of Inserts anywhere."""
    best = {"": (0, "", ())}

    def with_inserts():
        for _ in range(4):
            for last, (c, a, t) in list(best.items()):
                for role in ("user", "assistant"):
                    if role[0] in STEP[last]:
                        way = (c + 3, a + "I", t + ((role, ""),))
                        if role[0] not in best or way[:2] < best[role[0]][:2]:
                            best[role[0]] = way

    for (role, text), fault in zip(rows, slow_faults(rows)):
        with_inserts()
        new = {}
        for last, (c, a, t) in best.items():
            ways = [(last, c + 4, a + "D", t)]
            if fault not in ("blank", "duplicate"):
                c += 3 * (fault == "truncated")
                if role[:1] and role[0] in STEP[last]:
                    ways.append((role[0], c, a + "K", t + ((role, text),)))
                for r in ("user", "assistant"):
                    if r[0] in STEP[last]:
                        ways.append((r[0], c + 3, a + "R", t + ((r, text),)))
            for q, *way in ways:
                if q not in new or tuple(way[:2]) < new[q][:2]:
                    new[q] = tuple(way)
        best = new
    with_inserts()
    return min((best[q] for q in ("", "a") if q in best), key=lambda w: w[:2])


def random_rows(rng, n):
    roles = rng.choice([["user", "assistant"], ["user"], ["system", "user", "assistant"], ["user", "assistant", "tool", "", "system"]])
    texts = ["One.", "two", "", " \n", "Three!", "four? ", "five"] + [f"w{k}{'.' * (k % 3 > 0)}" for k in range(n)]
    return [(rng.choice(roles), rng.choice(texts[rng.choice([0, 7, 7, 7]):] or texts)) for _ in range(n)]


def test_survivors_match_all_edits():
    rng = random.Random(7)
    for _ in range(1500):
        rows = random_rows(rng, rng.randint(0, 14))
        tree, emitted = C.Survivors(C.NONE), b""
        for (role, _), fault in zip(rows, slow_faults(rows)):
            kind = role[:1] if role[:1] in ("s", "u", "a") else ""
            tree.step(C.edits_of(kind, fault in ("blank", "duplicate"), fault == "truncated"))
            emitted += tree.resolved()
        cost, _, edits = min((c + C.END[q][0], k, e + C.END[q][1]) for k, (q, c, e) in enumerate(tree.open_ways()))
        assert (cost, (emitted + edits).decode()[::2]) == slow_repair(rows)[:2], rows


def test_survivors_hold_what_they_differ_in():
    """A long sound conversation is emitted as it goes; a run that stays
    undecided keeps one node a survivor and no more."""
    tree = C.Survivors(C.NONE)
    for k in range(20_000):
        tree.step(C.edits_of("ua"[k % 2], False, False))
        tree.resolved()
        assert sum(len(e) for _, _, e in tree.open_ways()) <= 16
    for k in range(2_001):
        tree.step(C.edits_of("u", False, False))
        tree.resolved()
    nodes = [tree.root]
    for n in nodes:
        nodes += n.children
    assert len(nodes) <= 8


def frame(spark, conversations):
    rows = [(c, k, role, text) for c, turns in conversations.items() for k, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("slice_turns", [1, 3, 4096])
def test_repair_across_slices(spark, slice_turns):
    rng = random.Random(slice_turns)
    conversations = {c: random_rows(rng, rng.randint(1, 24)) for c in range(60)}
    conversations[60] = [("user", f"u{k}.") for k in range(301)]                 # undecided to its end
    marked, edits, totals, dialogue = C.repair(frame(spark, conversations), slice_turns)
    cost = {r[C.KEY]: r["cost"] for r in totals.collect()}
    illegal = {r[C.KEY]: r["illegal"] for r in totals.collect()}
    audit, turns = {}, {}
    for r in sorted(edits.collect(), key=lambda r: (r[C.KEY], r["slice"])):
        audit[r[C.KEY]] = audit.get(r[C.KEY], "") + "".join(x for x in r["edits"] if not x.isdigit())
    for r in sorted(dialogue.collect(), key=lambda r: (r[C.KEY], r["ordinal"], r["sub"])):
        turns.setdefault(r[C.KEY], []).append((r["role"], r["text"]))
    for c, rows in conversations.items():
        want = slow_repair(rows)
        assert (cost[f"={c}"], audit[f"={c}"], tuple(turns.get(f"={c}", []))) == want, rows
        pairs = zip(rows, rows[1:])
        assert illegal[f"={c}"] == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)


def slow_query(rows):
    """The contract over collected rows of conversations."""
    fill = lambda x: " " if x is None else str(x)
    out, held = [], {c: [] for c, *_ in rows}
    for c, turn, role, text in rows:
        kind = zlib.crc32(f"{fill(c)}:{fill(turn)}".encode()) % 20
        role, text = fill(role), fill(text)
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        held[c] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for c, turns in held.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        plain = [t[1:] for t in turns]
        found, numbers = slow_faults(plain), [t[0] for t in turns if t[0] is not None]
        cost, audit, fixed = slow_repair(plain)
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in fixed)
        out.append((c, gaps, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, C.op12_conversation_repair(spark, SF).collect()), key=str) == slow_query(rows)


AWKWARD = ([(None, None, None, None), (None, 1, "user", "a."), (None, 1, "user", "a."), (1, None, "user", None), (1, None, "user", "x."),
            (1, 5, None, "y."), (1, 9, "assistant", "z" * 100_000), (2, 0, "system", "s."), (3, 0, "", "empty role."),
            (4, 3, "user", "Ä ß 日本 …"), (4, 3, "assistant", "tie."), (4, 3, "user", "tie."), (4, -2, "user", "\t\n"),
            (6, 7, "user", "only nulls"), (7, None, "user", "all null.")]
           + [(8, k, "user", "the same.") for k in range(40)] + [(9, k, "ua"[k % 2] + "x", f"t{k}.") for k in range(60)])


def test_query_awkward_rows(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "conv_id long, turn long, role string, text string")
    clash = {c: F.lit("clash") for c in ("slice", "ordinal", "edits", "fault", "entry", "cost", "kind", "lead")}
    df.withColumns(clash).write.parquet(f"{tmp_path}/conversations.parquet")
    want = slow_query(AWKWARD)
    assert sorted(map(tuple, C.op12_conversation_repair(spark, str(tmp_path)).collect()), key=str) == want
    assert sorted(map(tuple, C.op12_conversation_repair(spark, str(tmp_path), slice_turns=2).collect()), key=str) == want


def test_empty_table_and_dropped_conversations(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/a/conversations.parquet")
    spark.createDataFrame([(gone, 0, "user", "x.")], schema).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert C.op12_conversation_repair(spark, f"{tmp_path}/a").collect() == []
    row = C.op12_conversation_repair(spark, f"{tmp_path}/b").first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
