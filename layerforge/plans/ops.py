"""Ops reports over the run log and the quality results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_runs(log: DataFrame) -> DataFrame:
    """O3: run summary, newest first."""
    return (log.select("table_name", "run_type", "records_inserted", "records_updated",
                       "status", "duration_seconds", "run_timestamp")
               .orderBy(F.col("run_timestamp").desc()))


def report_dq(results: DataFrame) -> DataFrame:
    """Quality results, newest first."""
    return (results.select("check_name", "severity", "status", "affected_count",
                           "total_count", "sample_ids", "check_timestamp")
                   .orderBy(F.col("check_timestamp").desc()))


def report_failures(results: DataFrame) -> DataFrame:
    """Failed checks by severity (alphabetical), newest first."""
    return (results.filter(F.col("status") == "FAIL")
                   .orderBy(F.col("severity").asc(), F.col("check_timestamp").desc()))
