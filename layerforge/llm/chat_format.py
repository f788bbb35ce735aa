"""Chat formatting by perspective rotation (DataFrame functions only).

For every participant of a conversation the dialogue is rendered once with that
participant as the assistant, the others as named users, and the character spans
that the assistant is trained on (its texts and their end marks).

A conversation is rendered in parts of at most ``max_turns`` turns, so no group
that is gathered into one row grows without bound.  With ``whole``, as in the
query, every part is rendered for every participant of the whole conversation
and starts with the system turns that were before it, so the parts of a view add
up to the dialogue; without, a part is rendered by itself, for those who speak
in it.  The number of
a turn within its conversation comes from a range sort of all turns, not from a
window by conversation: a conversation that holds a third of all turns is spread
over many tasks, each of which counts on from where the one before it ended.

Defined results
---------------
* Turns are ordered by turn, role, text (nulls first).  Repeated turns are
  rendered as often as they occur.
* A null conv_id is a conversation like any other.
* A system turn is nobody's perspective and is rendered as such in all.  A turn
  without a role is an unnamed user's.  A conversation (without ``whole``, a
  part) without any participant gives no row, as does an empty table.
* System turns that are repeated at the head of a part appear there once for
  each role and text, in the order of their first places, and are not counted in
  n_turns.
* A null text is an empty one.  ``<|`` in a text or a role is written ``< |``,
  so that no text can pose as a mark.
* Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, read_table

MAX_TURNS = 128
END = "<|end|>\n"


def numbered(turns: DataFrame) -> DataFrame:
    """Adds ``ordinal``, the number of the turn in its conversation, from 0."""
    order = ["conv_id", "turn", "role", "text", "dealt"]
    rows = materialise(
        turns.select(F.col("conv_id"), F.col("turn"), F.col("role").cast("string").alias("role"),
                     F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("dealt"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("task", F.shiftright("row", 33)).drop("dealt"), "turns")
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each conversation and task: one, but for those that cross tasks
    runs = (rows.groupBy("conv_id", "task").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
                .select(F.col("conv_id").alias("c"), F.col("task").alias("t"), "first",
                        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    return (rows.join(runs, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("task") == F.col("t")))
                .select("conv_id", "turn", "role", "text", (F.col("row") - F.col("first") + F.col("offset")).alias("ordinal")))


def _plain(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))


def _system_before(placed: DataFrame, max_turns: int, is_system) -> DataFrame:
    """The system turns that were before each part, as turns of that part."""
    first = placed.filter(is_system(F.col("role"))).groupBy("conv_id", "role", "text").agg(F.min("ordinal").alias("ordinal"))
    last = placed.groupBy("conv_id").agg(F.max("part").alias("last")).filter("last > 0").withColumnRenamed("conv_id", "c")
    since = F.floor(F.col("ordinal") / max_turns) + 1
    return (first.join(last, F.col("conv_id").eqNullSafe(F.col("c"))).filter(since <= F.col("last"))
                 .select("conv_id", "role", "text", "ordinal", F.explode(F.sequence(since, F.col("last"))).alias("part"),
                         F.lit(True).alias("again")))


def rotate(turns: DataFrame, max_turns: int = MAX_TURNS, system_roles: tuple[str, ...] = ("system",),
           whole: bool = False) -> DataFrame:
    """One row for each conversation, part and participant who speaks in it
    (``whole``: in the conversation): conv_id, part, assistant, n_turns, n_own,
    rendered, and spans (array of start and end, in characters of ``rendered``)."""
    is_system = lambda r: r.isin(*system_roles)
    placed = numbered(turns).withColumn("part", F.floor(F.col("ordinal") / max_turns))
    held = placed.select("conv_id", "role", "text", "ordinal", "part", F.lit(False).alias("again"))
    if whole:
        held = held.unionByName(_system_before(placed, max_turns, is_system))
    parts = (held.groupBy("conv_id", "part")
             .agg(F.array_sort(F.collect_list(F.struct("ordinal", "role", "text", "again"))).alias("turns")))
    if whole:
        people = (turns.select(F.col("conv_id").alias("c"), F.col("role").cast("string").alias("assistant"))
                  .filter(F.col("assistant").isNotNull() & ~is_system(F.col("assistant"))).distinct())
        views = (parts.join(people, F.col("conv_id").eqNullSafe(F.col("c")))
                      .select("conv_id", "part", "turns", "assistant"))
    else:
        people = F.array_distinct(F.transform(F.filter("turns", lambda t: t["role"].isNotNull() & ~is_system(t["role"])),
                                              lambda t: t["role"]))
        views = parts.select("conv_id", "part", "turns", F.explode(people).alias("assistant"))

    def header(t):
        return (F.when(t["role"].isNull(), F.lit("<|user|>\n"))
                 .when(is_system(t["role"]), F.lit("<|system|>\n"))
                 .when(t["role"] == F.col("assistant"), F.lit("<|assistant|>\n"))
                 .otherwise(F.concat(F.lit("<|user name="), _plain(t["role"]), F.lit("|>\n"))))

    segments = F.transform("turns", lambda t: F.struct(
        (t["role"].isNotNull() & (t["role"] == F.col("assistant"))).alias("own"),
        t["again"].alias("again"), header(t).alias("head"), F.concat(_plain(t["text"]), F.lit("\n" + END)).alias("body")))
    views = views.select("conv_id", "part", "assistant", segments.alias("segments"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, s):
        start = acc["at"] + F.length(s["head"])
        end = start + F.length(s["body"])
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(s["own"], F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    return views.select(
        "conv_id", "part", "assistant", F.size(F.filter("segments", lambda s: ~s["again"])).cast("long").alias("n_turns"),
        F.size(F.filter("segments", lambda s: s["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"])), "").alias("rendered"),
        F.aggregate("segments", zero, step, lambda acc: acc["spans"]).alias("spans"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rotate(read_table(spark, sf_dir, "conversations"), whole=True)
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ";")
    return r.select("conv_id", "part", "assistant", "n_turns", "n_own", "rendered", spans.alias("spans"))


#: Participants are those of the whole conversation; each part begins with the
#: system turns before it, one for each text.
OP5_SQL = r"""
WITH o AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS ordinal
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, role AS assistant FROM o WHERE role IS NOT NULL AND role <> 'system'
), parts AS (
  SELECT DISTINCT conv_id, ordinal // 128 AS part FROM o
), rules AS (
  SELECT conv_id, role, text, min(ordinal) AS ordinal FROM o WHERE role = 'system' GROUP BY conv_id, role, text
), held AS (
  SELECT conv_id, ordinal // 128 AS part, role, text, ordinal, false AS again FROM o
  UNION ALL
  SELECT r.conv_id, p.part, r.role, r.text, r.ordinal, true
  FROM rules r JOIN parts p ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND p.part > r.ordinal // 128
), s AS (
  SELECT h.conv_id, h.part, v.assistant, h.ordinal, h.again,
         coalesce(replace(h.text, '<|', '< |'), '') || chr(10) || '<|end|>' || chr(10) AS body,
         coalesce(h.role = v.assistant, false) AS own,
         CASE WHEN h.role IS NULL THEN '<|user|>'
              WHEN h.role = 'system' THEN '<|system|>'
              WHEN h.role = v.assistant THEN '<|assistant|>'
              ELSE '<|user name=' || replace(h.role, '<|', '< |') || '|>' END || chr(10) AS head
  FROM held h JOIN people v ON h.conv_id IS NOT DISTINCT FROM v.conv_id
), c AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, part, assistant ORDER BY ordinal) AS stop FROM s
)
SELECT conv_id, part, assistant, count(*) FILTER (WHERE NOT again) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
       string_agg(head || body, '' ORDER BY ordinal) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN CAST(CAST(stop - length(body) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(stop AS BIGINT) AS VARCHAR) END,
                           ';' ORDER BY ordinal), '') AS spans
FROM c GROUP BY conv_id, part, assistant
"""
