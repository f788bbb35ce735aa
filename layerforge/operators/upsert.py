"""Conditional upsert (MERGE without a MERGE-capable table format).

``upsert`` returns the *new version* of the target as a DataFrame with an
``_action`` column (``insert`` / ``update`` / ``keep``); the caller writes it
as a new snapshot (``sources.sinks.write_snapshot``), so a failed run leaves
the previous version in place. Semantics follow the warehouse MERGE:

* match on equality of all keys (a NULL key never matches, so a source row
  with a NULL key is inserted);
* matched and ``changed`` holds -> listed ``update_cols`` come from the
  source, lineage is re-stamped; matched otherwise -> target row kept;
* not matched -> source row inserted with lineage; target rows are never
  deleted;
* two source rows for one key fail the job (the warehouse refuses such a
  MERGE; a join would silently multiply).

One plan for every size: updates come from a left join of the target with the
source, inserts from a left anti join of the source with the target's keys.
The target is scanned twice, the second time for its keys only; with the number
of source rows known, target rows whose keys are in no source row for certain
(``operators.key_bitmap``) are passed on without a shuffle, and only the others
are joined. There is no full outer join, so AQE may broadcast a side whose measured size allows it and
may split the rows of a hot key, on the target's side too. A NULL key never
matches: such target rows are kept by the outer side of the left join, such
source rows by the anti join. Source rows are numbered by key in the shuffle that
the join needs anyway; of a repeated key at most two rows a map task get that far
(a partial group limit), so it fails without its rows being gathered.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..context import RunContext, work_root
from ..functions.columns import changed as _changed
from ..functions.columns import ntz_lit
from ..sources import versions as V
from . import key_bitmap

#: Touched partition values that a merge reports.
MAX_LITERALS = 10_000

LINEAGE = ("_source_file", "_load_timestamp", "_batch_id")
def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _assert_unique(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source rows without a NULL in their key; lazily fails when a key
    repeats. The second row of a key is enough for that, so no more of them are
    kept, before the shuffle by key and after it."""
    w = Window.partitionBy(*keys).orderBy(*keys)
    second = F.assert_true(F.col("_rn") == 1, F.lit("upsert: source key matches more than one row"))
    return (source.filter(~_null_key(keys)).withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
                  .withColumn("_s", F.coalesce(second.cast("boolean"), F.lit(True))).drop("_rn"))


def _null_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])


def upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
           changed_on: str | Sequence[str] | Column, update_cols: Sequence[str],
           ctx: RunContext, source_label: str | None = None,
           null_safe_change: bool = False, check_unique: bool = True, source_rows: int | None = None) -> DataFrame:
    """New version of ``target`` after merging ``source``, which is read
    twice: pass a written or checkpointed frame where it is costly to make.

    ``changed_on``: column name(s) compared with ``!=`` (NULL means "not
    changed"; ``null_safe_change`` uses IS DISTINCT FROM), or a Column over
    ``t.<col>`` / ``s.<col>``. ``source_rows``: the number of source rows, if
    known; then only target rows that may match are shuffled.
    """
    keys = _cols(keys)
    out_cols = [c for c in target.columns if c != "_action"]
    has_lineage = all(c in out_cols for c in LINEAGE)
    rest = None
    if source_rows is not None:
        target, rest = key_bitmap.split(target, source, keys, source_rows)

    t = target.select(*out_cols).withColumn("_t", F.lit(True))
    # rows with a NULL key match nothing and are inserted without a join
    s = _assert_unique(source, keys) if check_unique else source.filter(~_null_key(keys)).withColumn("_s", F.lit(True))
    unkeyed = source.filter(_null_key(keys))
    ta, sa = t.alias("t"), s.alias("s")
    if isinstance(changed_on, Column):
        chg = changed_on
    else:
        chg = None
        for c in _cols(changed_on):
            one = _changed(F.col(f"t.{c}"), F.col(f"s.{c}"), null_safe=null_safe_change)
            chg = one if chg is None else (chg | one)
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]

    def action(matched: Column, is_t: Column, is_s: Column) -> Column:
        return (F.when(matched & F.coalesce(chg, F.lit(False)), F.lit("update"))
                 .when(matched, F.lit("keep"))
                 .when(is_s, F.lit("insert"))
                 .otherwise(F.lit("keep")))

    def project(j: DataFrame) -> DataFrame:
        is_t = F.col("t._t").isNotNull()
        is_s = F.col("s._s").isNotNull()
        j = j.withColumn("_action", action(is_t & is_s, is_t, is_s))
        a = F.col("_action")
        exprs = []
        for c in out_cols:
            if has_lineage and c == "_load_timestamp":
                e = F.when(a != "keep", F.current_timestamp()).otherwise(F.col("t._load_timestamp"))
            elif has_lineage and c == "_batch_id":
                e = F.when(a != "keep", F.lit(ctx.batch_id)).otherwise(F.col("t._batch_id"))
            elif has_lineage and c == "_source_file":
                label = F.lit(source_label) if source_label else F.col("s._source_file") \
                    if "_source_file" in source.columns else F.lit(None).cast("string")
                e = F.when(a == "insert", label).otherwise(F.col("t._source_file"))
            elif c in update_cols:
                e = F.when(a == "keep", F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
            else:
                e = F.when(a == "insert", F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
            exprs.append(e.cast(target.schema[c].dataType).alias(c))
        return j.select(*exprs, a)

    def inserted(frame: DataFrame) -> DataFrame:
        return frame.select(*[_insert_expr(c, has_lineage, ctx, source_label, source)
                              .cast(target.schema[c].dataType).alias(c) for c in out_cols],
                            F.lit("insert").alias("_action"))

    kept_or_updated = project(ta.join(sa, cond, "left"))
    new = s.join(target.select(*keys), keys, "left_anti").select(*[F.col(f"`{c}`") for c in source.columns])
    out = kept_or_updated.unionByName(inserted(new.unionByName(unkeyed)))
    return out if rest is None else out.unionByName(rest.select(*[F.col(f"`{c}`") for c in out_cols], F.lit("keep").alias("_action")))


def _insert_expr(c: str, has_lineage: bool, ctx: RunContext, label: str | None,
                 source: DataFrame) -> Column:
    if has_lineage and c == "_load_timestamp":
        return F.current_timestamp()
    if has_lineage and c == "_batch_id":
        return F.lit(ctx.batch_id)
    if has_lineage and c == "_source_file":
        if label:
            return F.lit(label)
        return F.col(c) if c in source.columns else F.lit(None).cast("string")
    return F.col(c)


def newer_than(df: DataFrame, ts_col: str, mark) -> DataFrame:
    """Rows strictly after the high-water mark (equal is excluded, NULL
    is excluded)."""
    dtype = df.schema[ts_col].dataType
    if isinstance(mark, Column):
        m = mark
    elif dtype.typeName() == "timestamp_ntz":
        m = ntz_lit(mark)                  # zone-free, whatever the session zone
    else:
        m = F.lit(mark).cast(dtype)
    return df.filter(F.col(ts_col) > m)


def merge_stats(result: DataFrame) -> DataFrame:
    """One row of counts per action from the ``_action`` column, in one
    pass (partial aggregation before the single-row merge)."""
    a = F.col("_action")
    return result.agg(
        F.count_if(a == "insert").cast("bigint").alias("inserted"),
        F.count_if(a == "update").cast("bigint").alias("updated"),
        F.count_if(a == "keep").cast("bigint").alias("kept"),
        F.count(F.lit(1)).alias("total"))


def upsert_partitions(spark, root: str, source: DataFrame, keys: str | Sequence[str],
                      changed_on, update_cols: Sequence[str], ctx: RunContext,
                      part_col: str, part_of, source_label: str | None = None,
                      **kw) -> dict:
    """U1 on a versioned table (``sources.versions``) that is partitioned by
    ``part_col``, rewriting only the partitions it touches.

    ``part_of`` maps a source frame to the partition value of each source row
    (e.g. the month of the purchase time). Touched partitions are those of the
    source rows (inserts land there) and those of the target rows the source
    matches (updates stay in their partition, because the partition column is not
    in ``update_cols``), NULL included; they are found from the key and partition
    columns only. Their rows are merged into new files, and one commit exchanges
    their files in the manifest; the files of all other partitions are carried
    over unread. Nothing live is renamed. With ``evolve``, columns of the source
    that are new to the table, or wider, are its columns from then on. Returns the touched values (the first
    ``MAX_LITERALS``) and the merge counts.
    """
    if part_col in update_cols:
        raise ValueError("the partition column cannot be updated")

    def choose(files, target, src, matched):
        touched = src.select(V.part_key([part_col]).alias("part")).union(
            matched.select(V.part_key([part_col]).alias("part"))).distinct()
        return files.join(touched, "part", "left_semi")

    return _merge_files(spark, root, source, _cols(keys), changed_on, update_cols, ctx, choose, part_col, part_of,
                        source_label, **kw)


def upsert_files(spark, root: str, source: DataFrame, keys: str | Sequence[str],
                 changed_on, update_cols: Sequence[str], ctx: RunContext, part_col: str | None = None, part_of=None,
                 source_label: str | None = None, **kw) -> dict:
    """U1 on a versioned table by copy-on-write of single files: only files that
    hold a matched key are rewritten, inserted rows go to new files, and all
    other files are carried over in the manifest. Of these, only the key columns
    are read, to see that they hold no matched key. For a partitioned table,
    ``part_col`` and ``part_of`` as for ``upsert_partitions``."""
    return _merge_files(spark, root, source, _cols(keys), changed_on, update_cols, ctx,
                        lambda files, target, src, matched: files.join(matched.select(F.col("_path").alias("path")).distinct(),
                                                                       "path", "left_semi"),
                        part_col, part_of, source_label, **kw)


def _merge_files(spark, root, source, keys, changed_on, update_cols, ctx, choose, part_col, part_of, source_label,
                 evolve: bool = False, **kw) -> dict:
    base = V.head(spark, root)
    if base is None:
        raise FileNotFoundError(f"no live version under {root}")
    schema, parts = base.struct(), list(base.partition_by)
    if evolve:
        own = source.select(*[c for c in source.columns if c != part_col])
        schema = V.merged_schema(schema, own.schema)
    target = V.scan(spark, root, base, with_path=True, schema=schema)
    work_root(spark)
    src = source
    if part_col is not None:
        src = src.withColumn(part_col, part_of(source).cast(schema[part_col].dataType))
    src = src.checkpoint(eager=True)
    src_keys, n = src.select(*keys), src.count()
    near = key_bitmap.may_match(target.select(*keys, *parts, "_path"), src_keys, keys, n)
    matched = near.join(src_keys, keys, "left_semi").select(*parts, "_path").distinct().checkpoint()
    hit = choose(V.files(spark, root, base), target, src, matched).select(*V.files(spark, root, base).columns).checkpoint()
    rows = V.scan(spark, root, base, hit, schema=schema)
    merged = upsert(rows, src, keys, changed_on, update_cols, ctx, source_label=source_label, source_rows=n, **kw)
    obs = Observation(f"upsert_files_{uuid.uuid4().hex}")
    a = F.col("_action")
    merged = merged.observe(obs, F.count_if(a == "insert").alias("inserted"),
                            F.count_if(a == "update").alias("updated"),
                            F.count_if(a == "keep").alias("kept"))
    attempt, added = V.write_files(merged.drop("_action").select(*schema.names), root, parts)

    def unconcerned(now, new):
        # rows that others added meanwhile must hold none of the keys that were merged
        return V.scan(spark, root, now, new).join(src_keys, keys, "left_semi").isEmpty()

    done = V.commit(spark, root, ctx.batch_id, "merge", schema, parts, base, added, hit, attempt, recheck=unconcerned)
    # without source rows no file is hit, and the optimizer drops the empty plan with its counts
    m = obs.get if n else {"inserted": 0, "updated": 0, "kept": 0}
    values = []
    if part_col is not None:
        touched = src.select(part_col).union(matched.select(part_col)).distinct()
        values = [r[0] for r in touched.orderBy(F.col(part_col).asc_nulls_first()).limit(MAX_LITERALS).collect()]
    return {"partitions": values, "inserted": int(m["inserted"]), "updated": int(m["updated"]), "kept": int(m["kept"]),
            "files_rewritten": hit.count(), "commit": done}
