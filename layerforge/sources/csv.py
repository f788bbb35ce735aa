"""Lenient CSV ingest into the raw layer.

Raw tables are read with an explicit all-string schema (types are applied in
the curate step, so leading zeros and odd values survive), the header row is
skipped, an empty field (quoted or not) is NULL and a UTF-8 BOM before the
header is dropped by the reader. A line that does not fit the schema (too
many or too few fields) is a bad record: up to ``max_bad`` of them are
tolerated per table, more fail the load and leave the live version alone.

``multiline=True`` admits quoted newlines but makes a file unsplittable (one
task per file), so it is meant for free-text files only.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import cast_timestamp
from .sinks import move_pointer, path_exists, read_current, refuse_known, write_full

CORRUPT = "_corrupt_record"
REJECTED = "is_rejected"
#: Prefix of the typed copies of text columns.
TYPED = "_typed_"


class BadRecordBudgetExceeded(RuntimeError):
    pass


def string_schema(cols: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def _reader(spark: SparkSession, schema: T.StructType, multiline: bool, header: bool = True):
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.schema(full)
            .option("header", header).option("multiLine", multiline)
            .option("quote", '"').option("escape", '"').option("nullValue", "")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))


def parse_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False,
              header: bool = True, with_file_name: bool = False) -> DataFrame:
    """Parsed rows plus the ``_corrupt_record`` text of bad lines;
    ``with_file_name`` adds ``_source_file`` with the name of the file each
    row came from (the scan's ``_metadata`` column)."""
    df = _rows(spark, path, schema, multiline, header, with_file_name)
    # a multi-line file is parsed by one task; what follows need not stay in it
    return df.hint("rebalance") if multiline else df


def _rows(spark, path, schema, multiline, header, with_file_name) -> DataFrame:
    df = _reader(spark, schema, multiline, header).csv(path)
    return df.withColumn("_source_file", F.col("_metadata.file_name")) if with_file_name else df


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType, max_bad: int = 0,
                 multiline: bool = False, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1+S2 for direct use: ``(good, rejected)`` frames after checking the
    bad-record budget (one counting pass; ``load_raw_csv`` does without)."""
    parsed = parse_csv(spark, path, schema, multiline, header)
    first = F.col(schema.fieldNames()[0])
    # every use below also references a data column: Spark refuses CSV scans
    # that read only the corrupt-record column (e.g. a bare count of the
    # good rows after column pruning)
    touch = first.isNull() | first.isNotNull()
    is_bad = F.col(CORRUPT).isNotNull() & touch
    bad = parsed.agg(F.count_if(is_bad).alias("bad")).first()["bad"]
    if bad > max_bad:
        raise BadRecordBudgetExceeded(f"{path}: {bad} bad records > budget {max_bad}")
    good = parsed.filter(F.col(CORRUPT).isNull() & touch).drop(CORRUPT)
    rejected = parsed.filter(is_bad).select(CORRUPT, schema.fieldNames()[0])
    return good, rejected


def load_raw_csv(spark: SparkSession, path: str, schema: T.StructType, table_root: str,
                 version: str, max_bad: int = 0, multiline: bool = False,
                 header: bool = True, with_file_name: bool = False,
                 types: Mapping[str, str] | None = None, typed_copies: Sequence[str] = ()) -> dict:
    """S1+S2+S5: the good rows are written into a new version while an
    ``Observation`` counts them and the bad ones, by the tasks that parse them,
    without a shuffle; only if there are bad rows, a second pass writes these
    beside them (as partitions of a rejected flag). The pointer moves only within
    budget.

    ``types`` (column -> type name) also counts a value that is present but
    does not convert (``try_cast`` is NULL) as a bad record, as a typed
    warehouse load does; the raw values themselves stay text. A timestamp
    column in ``typed_copies`` is also written typed, as ``_typed_<name>``
    (NULL if it does not convert): its parquet statistics serve filters that
    a cast of text cannot push down, such as the high-water mark's."""
    parsed = _rows(spark, path, schema, multiline, header, with_file_name)
    bad_row = F.col(CORRUPT).isNotNull()
    for c, t in (types or {}).items():
        bad_row = bad_row | (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
    obs = Observation(f"csv_{uuid.uuid4().hex}")
    for c in typed_copies:
        # a value that does not convert must not fail the strict cast
        checked = parsed.withColumn("_text", F.when(F.col(c).try_cast("timestamp").isNotNull(), F.col(c)))
        parsed = checked.withColumn(TYPED + c, cast_timestamp(checked, "_text")).drop("_text")
    flagged = parsed.withColumn(REJECTED, bad_row)
    counted = flagged.observe(obs, F.count(F.lit(1)).alias("lines"), F.count_if(F.col(REJECTED)).alias("bad"))
    seq, folder = refuse_known(spark, table_root, version)
    vpath = f"{table_root}/{folder}"
    write_full(counted.filter(~F.col(REJECTED)).drop(REJECTED), f"{vpath}/{REJECTED}=false")
    m = obs.get
    # also where an attempt that was lost or over its budget left some
    if m["bad"] or path_exists(spark, f"{vpath}/{REJECTED}=true"):
        write_full(flagged.filter(REJECTED).drop(REJECTED), f"{vpath}/{REJECTED}=true")
    if m["bad"] > max_bad:
        raise BadRecordBudgetExceeded(f"{path}: {m['bad']} bad records > budget {max_bad}")
    move_pointer(spark, table_root, seq, version, f"{folder}/{REJECTED}=false")
    return {"rows": int(m["lines"] - m["bad"]), "rejected": int(m["bad"])}


def read_raw(spark: SparkSession, table_root: str) -> DataFrame:
    """Live good rows of a raw table written by ``load_raw_csv``."""
    return read_current(spark, table_root).drop(CORRUPT)


INGEST_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("rows_loaded", T.LongType(), True),
    T.StructField("rows_rejected", T.LongType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("error_message", T.StringType(), True),
])


def ingest_all(spark: SparkSession, src_dir: str, mapping: Mapping[str, tuple[str, Sequence[str]]],
               raw_root: str, version: str, budgets: Mapping[str, int] | None = None,
               multiline: Sequence[str] = (), types: Mapping[str, Mapping[str, str]] | None = None,
               with_file_name: bool = False, typed_copies: Mapping[str, Sequence[str]] | None = None,
               parallel: int = 4) -> DataFrame:
    """Load every mapped file (file -> (table, columns)), up to
    ``parallel`` at a time; a missing file is reported and skipped, a failing
    one reported with its whole error text, the others still load. ``types``
    has the column types of each table whose conversion failures count as
    bad records. Returns one report row per file, in the mapping's order."""
    def one(item):
        fname, (table, cols) = item
        path = f"{src_dir}/{fname}"
        if not path_exists(spark, path):
            return table, fname, 0, 0, "MISSING", None
        try:
            m = load_raw_csv(spark, path, string_schema(cols), f"{raw_root}/{table}", version,
                             max_bad=(budgets or {}).get(table, 0), multiline=table in multiline,
                             types=(types or {}).get(table), with_file_name=with_file_name,
                             typed_copies=(typed_copies or {}).get(table, ()))
            return table, fname, m["rows"], m["rejected"], "LOADED", None
        except Exception as exc:  # noqa: BLE001 - reported per file
            return table, fname, 0, 0, "FAILED", str(exc)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows = list(pool.map(one, mapping.items()))
    return spark.createDataFrame(rows, INGEST_SCHEMA)


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str = "none", rows_a_file: int = 0) -> None:
    """Text export used by round trips: every value as text, blanks kept. A
    compressed or multi-line file is read by one task, so ``rows_a_file`` bounds
    its rows (0: no bound)."""
    (df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
       .write.mode("overwrite").option("header", header).option("compression", compression).option("maxRecordsPerFile", rows_a_file)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("quote", '"').option("escape", '"').csv(path))
