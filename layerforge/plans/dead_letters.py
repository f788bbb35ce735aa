"""Rejected rows of the loads, and their way back.

``split_write`` writes a frame once, partitioned by whether a rule rejects the
row: one scan and one pass give both the good rows and the rejects. The rejects of
an attempt are added to one versioned table for all tables of the lake, each row
as JSON with its reasons and an id made of its batch and content.

A corrected reject enters a later batch exactly once. ``claim`` records, in a
ledger, which rejects a batch takes, *before* the batch uses them: what another
batch has claimed is left out, what the same batch has claimed is given again. So
a batch that is lost after the claim and run again under its id gets the same rows,
and no other batch ever does. Two batches that claim at the same time start from
one version of the ledger; the second is refused by the commit and looks again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..context import RunContext, new_run_dir
from ..sources import versions as V

def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


REJECTS = _texts("table_name", "batch_id", "reject_id", "reject_reason", "row")
LEDGER = _texts("table_name", "reject_id", "claimed_by")


def reasons(rules: Mapping[str, Column]) -> Column:
    """The names of the rules that a row breaks, joined by commas; '' for none.
    A rule that is NULL is not broken."""
    return F.concat_ws(",", *[F.when(F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules.items()])


def split_write(df: DataFrame, table: str, rules: Mapping[str, Column], ctx: RunContext, rejects_root: str,
                out: str | None = None) -> tuple[DataFrame, dict]:
    """Write ``df`` in one pass into good rows and rejects; returns the good rows,
    read back, and the counts ``good`` and ``rejected``. The rejects are committed
    to the rejects table under the batch's id: once, however often it is run."""
    spark = df.sparkSession
    out = out or new_run_dir(spark, f"split-{table}")
    obs = Observation()
    tagged = df.withColumn("_reasons", reasons(rules)).withColumn("_rejected", F.col("_reasons") != "")
    tagged = tagged.observe(obs, F.count_if(~F.col("_rejected")).alias("good"), F.count_if("_rejected").alias("rejected"))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_rejected").parquet(out)
    both = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_reasons", T.StringType()),
                                           T.StructField("_rejected", T.BooleanType())])).parquet(out)
    bad = both.filter("_rejected")
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    rows = bad.select(F.lit(table).alias("table_name"), F.lit(ctx.batch_id).alias("batch_id"), row.alias("row"),
                      F.col("_reasons").alias("reject_reason"))
    # equal rows are told apart by their number among their equals
    same = Window.partitionBy("row").orderBy("reject_reason")
    named = rows.withColumn("reject_id", F.sha2(F.concat_ws("|", "table_name", "batch_id", "row", F.row_number().over(same).cast("string")), 256))
    _add(spark, rejects_root, f"{ctx.batch_id}/{table}", named.select(*REJECTS.names), REJECTS)
    return both.filter("NOT _rejected").drop("_reasons", "_rejected"), obs.get


def _add(spark: SparkSession, root: str, version: str, rows: DataFrame, schema: T.StructType) -> None:
    """Append under a name, unless a commit of that name is there already."""
    if V.head(spark, root) is None:
        try:
            V.replace(spark.createDataFrame([], schema), root, "empty")
        except V.Conflict:
            pass                                      # another writer made the table
    if version not in {c.version for c in V.history(spark, root)}:
        V.append(rows, root, version)


def open_rejects(spark: SparkSession, rejects_root: str, ledger_root: str, table: str, batch_id: str | None = None) -> DataFrame:
    """Rejects of a table that no batch but ``batch_id`` has claimed."""
    rows = V.read(spark, rejects_root).filter(F.col("table_name") == table)
    if V.head(spark, ledger_root) is None:
        return rows
    taken = V.read(spark, ledger_root).filter((F.col("table_name") == table) & ~F.col("claimed_by").eqNullSafe(F.lit(batch_id)))
    return rows.join(taken.select("reject_id"), "reject_id", "left_anti").select(*REJECTS.names)


def claim(spark: SparkSession, rejects_root: str, ledger_root: str, table: str, schema: T.StructType,
          fix: Callable[[DataFrame], DataFrame], rules: Mapping[str, Column], ctx: RunContext, tries: int = 5) -> DataFrame:
    """The rejects of ``table`` that ``fix`` corrects, as rows to add to the
    batch's input. ``fix`` maps parsed rows to corrected ones (columns of
    ``schema``, and ``reject_id`` carried along); those that break no rule any
    more are claimed for the batch, the others stay open."""
    for _ in range(tries):
        base = V.head(spark, ledger_root)
        if base is None:
            try:
                base = V.replace(spark.createDataFrame([], LEDGER), ledger_root, "empty")
            except V.Conflict:
                continue
        open_ = open_rejects(spark, rejects_root, ledger_root, table, ctx.batch_id)
        parsed = open_.select("reject_id", F.from_json("row", schema).alias("r")).select("r.*", "reject_id")
        fixed = fix(parsed).withColumn("_left", reasons(rules)).filter("_left = ''").drop("_left").checkpoint(eager=True)
        mine = V.read(spark, ledger_root).filter((F.col("table_name") == table) & (F.col("claimed_by") == ctx.batch_id))
        if mine.isEmpty():
            rows = fixed.select(F.lit(table).alias("table_name"), "reject_id", F.lit(ctx.batch_id).alias("claimed_by"))
            attempt, added = V.write_files(rows, ledger_root)
            try:
                # no recheck: whoever claimed meanwhile may have claimed these
                V.commit(spark, ledger_root, f"{ctx.batch_id}/{table}", "claim", LEDGER, (), base, added, None, attempt)
            except V.Conflict:
                continue
            return fixed.drop("reject_id")
        # claimed before this batch was lost: the same rows again, and no more
        return fixed.join(mine.select("reject_id"), "reject_id", "left_semi").drop("reject_id")
    raise V.Conflict(f"{ledger_root}: no claim in {tries} tries")
