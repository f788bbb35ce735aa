"""Operational extensions proposed alongside the loads (X1-X8): partitioned
layout, alert thresholds, replay bookkeeping, reject tables, schema diffs,
data contracts, masking and snapshot expiry. All are DataFrame operators; what
the driver gets is at most a row for each column or rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ntz_lit
from ..context import RunContext
from ..sources.sinks import current_version, path_exists


# ------------------------------------------------------------- X1 layout

def with_month(df: DataFrame, ts_col: str, alias: str = "month") -> DataFrame:
    """Month partition column ``yyyy-MM`` derived from a timestamp, for
    ``write_full(partition_by=[alias])`` and partition pruning on read."""
    return df.withColumn(alias, F.date_format(F.col(ts_col), "yyyy-MM"))


# ----------------------------------------------------------- X2 threshold

def with_threshold(results: DataFrame, limits: Mapping[str, float],
                   default: float | None = None) -> DataFrame:
    """Per-check tolerance: ``alert`` when affected/total exceeds the check's
    limit (a FAIL within tolerance does not alert). The limits are a tiny
    literal map, applied as a column expression (no join)."""
    m = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(float(v)))]) \
        if limits else F.create_map().cast("map<string,double>")
    lim = F.coalesce(m[F.col("check_name")], F.lit(default).cast("double"))
    ratio = F.when(F.col("total_count") > 0, F.col("affected_count") / F.col("total_count"))
    return results.withColumns({
        "threshold": lim,
        "alert": F.coalesce(ratio > lim, F.lit(False)),
    })


# -------------------------------------------------------------- X3 replay

def pending_tables(spark: SparkSession, log: DataFrame, batch_id: str,
                   tables: Sequence[str]) -> DataFrame:
    """Tables of ``batch_id`` without a SUCCESS row in the run log: the ones
    to (re)run when resuming a failed batch (anti join on the log)."""
    expected = spark.createDataFrame([(t, i) for i, t in enumerate(tables)],
                                     "table_name string, position int")
    done = log.filter((F.col("batch_id") == batch_id) & (F.col("status") == "SUCCESS")) \
              .select("table_name")
    return expected.join(done, "table_name", "left_anti")


def drop_batch(df: DataFrame, batch_id: str, batch_col: str = "_batch_id") -> DataFrame:
    """Idempotent replay: rows of every batch but ``batch_id`` (write the
    result as a new version before re-running the batch)."""
    return df.filter(~F.col(batch_col).eqNullSafe(F.lit(batch_id)))


# ------------------------------------------------------------ X4 rejects

def split_rejects(df: DataFrame, rules: Mapping[str, Column], ctx: RunContext
                  ) -> tuple[DataFrame, DataFrame]:
    """Rows failing any rule go to a rejects frame with the comma-joined
    reasons and the batch id; the others pass. One pass computes the
    reasons column; both outputs are filters of it."""
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(name))
                                        for name, p in rules.items()]))
    tagged = df.withColumn("_reasons", reasons)
    good = tagged.filter(F.size("_reasons") == 0).drop("_reasons")
    rejects = (tagged.filter(F.size("_reasons") > 0)
               .withColumn("reject_reason", F.concat_ws(",", "_reasons"))
               .withColumn("_batch_id", F.lit(ctx.batch_id))
               .drop("_reasons"))
    return good, rejects


def try_cast_failed(c: str, type_name: str) -> Column:
    """Rule helper: value present but not castable (``try_cast`` is NULL)."""
    return F.col(c).isNotNull() & F.col(c).try_cast(type_name).isNull()


# ---------------------------------------------------------- X5 schema diff

SCHEMA_SNAPSHOT = "column_name string, data_type string, nullable boolean, position int"


def schema_snapshot(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(df.schema.fields)],
        SCHEMA_SNAPSHOT)


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Column changes between two snapshots: dropped and type-changed are
    BREAKING, an added nullable column is a WARNING (non-nullable: BREAKING)."""
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, F.col("o.column_name") == F.col("n.column_name"), "full_outer")
    change = (F.when(F.col("o.column_name").isNull(), F.lit("added"))
               .when(F.col("n.column_name").isNull(), F.lit("dropped"))
               .when(F.col("o.data_type") != F.col("n.data_type"), F.lit("type_changed")))
    sev = (F.when(change == "added", F.when(F.col("n.nullable"), F.lit("WARNING"))
                  .otherwise(F.lit("BREAKING")))
            .when(change.isNotNull(), F.lit("BREAKING")))
    return j.select(F.coalesce(F.col("o.column_name"), F.col("n.column_name")).alias("column_name"),
                    F.col("o.data_type").alias("old_type"), F.col("n.data_type").alias("new_type"),
                    change.alias("change"), sev.alias("severity")).filter(F.col("change").isNotNull())


SCHEMA_VERSIONS = "table_name string, batch_id string, captured_at timestamp_ntz, " + SCHEMA_SNAPSHOT


class BreakingSchemaChange(RuntimeError):
    pass


SCHEMA_CHANGES = ("table_name string, batch_id string, column_name string, old_type string, new_type string, "
                  "change string, severity string")


def record_schema(spark: SparkSession, df: DataFrame, table: str, ctx: RunContext, path: str,
                  halt: bool = True, changes_path: str | None = None) -> DataFrame:
    """Compare a table's schema with the last one stored for it in the
    ``schema_versions`` table, append it, and return the differences. With
    ``halt`` a breaking change raises before the schema is stored; the
    differences are appended to ``changes_path`` in any case."""
    snap = schema_snapshot(spark, df)
    if path_exists(spark, path):
        stored = spark.read.schema(SCHEMA_VERSIONS).parquet(path).filter(F.col("table_name") == table)
        last = stored.agg(F.max(F.struct("captured_at", "batch_id")).alias("m")).first()["m"]
        if last is None:
            diff = schema_diff(snap, snap)
        else:
            diff = schema_diff(stored.filter((F.col("captured_at") == ntz_lit(last["captured_at"]))
                                             & (F.col("batch_id") == last["batch_id"])), snap)
    else:
        diff = schema_diff(snap, snap)
    rows = diff.collect()                                  # at most one row a column
    if changes_path and rows:
        spark.createDataFrame([(table, ctx.batch_id, *r) for r in rows], SCHEMA_CHANGES).coalesce(1) \
             .write.mode("append").parquet(changes_path)
    broken = [r["column_name"] for r in rows if r["severity"] == "BREAKING"]
    if halt and broken:
        raise BreakingSchemaChange(f"{table}: " + ", ".join(sorted(broken)))
    (snap.select(F.lit(table).alias("table_name"), F.lit(ctx.batch_id).alias("batch_id"),
                 ntz_lit(ctx.run_ts).alias("captured_at"), *snap.columns).write.mode("append").parquet(path))
    return spark.createDataFrame(rows, diff.schema)


def write_rejects(rejects: DataFrame, table: str, path: str) -> None:
    """Append rejected rows to the rejects table: table, batch, reason and
    the row itself as JSON, so rows of all tables fit one schema."""
    row = F.to_json(F.struct(*[F.col(c) for c in rejects.columns if c not in ("reject_reason", "_batch_id")]))
    (rejects.select(F.lit(table).alias("table_name"), F.col("_batch_id").alias("batch_id"), "reject_reason",
                    row.alias("row")).write.mode("append").parquet(path))


def contract_checks(df: DataFrame, table: str, contract: Mapping, ctx: RunContext) -> DataFrame:
    """``validate_contract`` as rows of ``dq_results``, one a rule."""
    counts = validate_contract(df, contract)
    rules = [c for c in counts.columns if c != "rows"]
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("affected")) for r in rules]))
    return counts.select("rows", each.alias("e")).select(
        F.lit(ctx.batch_id).alias("batch_id"), F.concat(F.lit(f"contract_{table}_"), F.col("e.rule")).alias("check_name"),
        F.concat(F.lit("Contract rule "), F.col("e.rule")).alias("check_description"), F.lit(table).alias("table_name"),
        F.lit("ERROR").alias("severity"),
        F.when(F.col("e.affected") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        F.col("e.affected").alias("affected_count"), F.col("rows").alias("total_count"), F.lit("[]").alias("sample_ids"),
        ntz_lit(ctx.run_ts).alias("check_timestamp"))


# ------------------------------------------------------------ X6 contract

def daily_volume_breaches(df: DataFrame, ts_col: str, min_rows: int, first_day=None, last_day=None) -> DataFrame:
    """Days whose row count is under the contract floor, days without any row
    included: every day from ``first_day`` to ``last_day`` (by default those
    of the data) is joined with the counts by day (partial aggregation).
    Rows without a time belong to no day."""
    per_day = (df.filter(F.col(ts_col).isNotNull()).groupBy(F.to_date(F.col(ts_col)).alias("day"))
                 .agg(F.count(F.lit(1)).alias("rows")))
    ends = per_day.agg(F.coalesce(F.lit(first_day).cast("date"), F.min("day")).alias("a"),
                       F.coalesce(F.lit(last_day).cast("date"), F.max("day")).alias("b"))
    days = ends.filter(F.col("a") <= F.col("b")).select(F.explode(F.sequence("a", "b")).alias("day"))
    return (days.join(per_day, "day", "left").select("day", F.coalesce("rows", F.lit(0)).alias("rows"))
                .filter(F.col("rows") < min_rows))


def freshness(df: DataFrame, ts_col: str, now, max_hours: float) -> DataFrame:
    """One row: newest timestamp, its age in hours at ``now`` and whether it
    breaches the freshness limit (an empty table breaches)."""
    newest = F.max(F.col(ts_col))
    age = (F.unix_timestamp(ntz_lit(now).cast("timestamp"))
           - F.unix_timestamp(newest.cast("timestamp"))) / 3600.0
    return df.agg(newest.alias("newest"), age.alias("age_hours")).withColumn(
        "stale", F.coalesce(F.col("age_hours") > max_hours, F.lit(True)))


def validate_contract(df: DataFrame, contract: Mapping) -> DataFrame:
    """Types, nullability, allowed values and ranges as one fused one-row
    aggregate of violation counts (column ``<rule>``), one scan. A column that
    is missing violates its ``<column>__missing`` rule once and no other;
    ``max_null_rate`` counts the NULLs beyond that share of the rows."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c, spec in contract.get("columns", {}).items():
        aggs.append(F.lit(int(c not in df.columns)).cast("bigint").alias(f"{c}__missing"))
        if c not in df.columns:
            continue
        if "max_null_rate" in spec:
            over = F.count_if(F.col(c).isNull()) - F.floor(F.count(F.lit(1)) * F.lit(float(spec["max_null_rate"])))
            aggs.append(F.greatest(over, F.lit(0)).cast("bigint").alias(f"{c}__null_rate"))
        if "type" in spec:
            aggs.append(F.count_if(try_cast_failed(c, spec["type"])).alias(f"{c}__type"))
        if spec.get("nullable") is False:
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__null"))
        if "allowed" in spec:
            aggs.append(F.count_if(~F.col(c).isin(list(spec["allowed"]))).alias(f"{c}__allowed"))
        if "range" in spec:
            lo, hi = spec["range"]
            aggs.append(F.count_if(~F.col(c).between(lo, hi)).alias(f"{c}__range"))
    return df.agg(*aggs)


# --------------------------------------------------------------- X7 masks

def mask(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """PII columns replaced by a keyed SHA-256 hex digest: joinable under one
    key. Values from a small domain, such as zip codes, can be found by trial
    by whoever has the key, so it must be kept like the data itself."""
    return df.withColumns({c: F.sha2(F.concat(F.lit(key), F.lit(":"), F.col(c).cast("string")), 256) for c in cols})


def rows_for(df: DataFrame, tenant_col: str, tenant) -> DataFrame:
    """Row filter of a derived per-tenant view."""
    return df.filter(F.col(tenant_col) == F.lit(tenant))


# -------------------------------------------------------------- X8 expiry

def expired(log: DataFrame, now, days: int = 90, live: Sequence[str] = ()) -> DataFrame:
    """Batches whose run started more than ``days`` before ``now``: their
    snapshots may be removed (deletion itself stays a manual step). ``live`` names
    the versions that tables still read (``live_versions``): these are never
    listed, however old. For tables with manifests, ``sources.versions.removable``
    lists the files instead."""
    cutoff = ntz_lit(now) - F.make_interval(days=F.lit(days))
    return (log.groupBy("batch_id").agg(F.max("run_timestamp").alias("last_run"))
               .filter((F.col("last_run") < cutoff) & ~F.col("batch_id").isin(list(live))))


def live_versions(spark: SparkSession, curated_root: str, tables: Sequence[str]) -> list[str]:
    """The version that each table reads now, one name a table at most."""
    names = {current_version(spark, f"{curated_root}/{t}") for t in tables}
    return sorted(n for n in names if n is not None)
