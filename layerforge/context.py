"""Run identity, session settings and the shared work folder.

A run is identified by a batch id and a start time that are stamped on every
curated row and every ops-log row. Both are plain literals in the plan, so
Catalyst folds them and every task sees the same value.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import SparkSession

# Session settings the library relies on. ANSI casts make a malformed value
# fail the statement (strict CAST semantics); UTC keeps calendar-date maths
# independent of the machine zone; AQE re-plans joins and shuffle sizes from
# runtime statistics and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


@dataclass(frozen=True)
class RunContext:
    """Identity of one load or check run."""

    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    run_ts: datetime = field(
        default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None)
    )


def cluster_conf(input_bytes: int, bytes_per_shuffle_partition: int = 1024 ** 3,
                 max_partitions: int = 50_000, shuffled_per_input: float = 1.0) -> dict:
    """Shuffle sizing for a cluster run over ``input_bytes`` of input.

    Dedup windows and merges shuffle whole rows, and compressed parquet
    grows when it is shuffled, so ``input_bytes`` is multiplied by
    ``shuffled_per_input`` (measure it for your tables) before it is divided
    into partitions. AQE coalesces small partitions towards 128 MB and splits
    skewed join partitions, but it never splits a window's partition, which
    is why the width comes from shuffled bytes. The upper clamp bounds the
    map x reduce block count: at 100 TB of input and a factor of 3 a window
    task then reads about 6 GB instead of 1 GB and sorts it on disk, which is
    slower but complete. Raise it where the shuffle service can take more.
    """
    n = int(min(max_partitions, max(200, input_bytes * shuffled_per_input // bytes_per_shuffle_partition)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 ** 2),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 ** 2),
    }


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings above to an existing session; with
    ``input_bytes`` also the shuffle sizing of ``cluster_conf``."""
    conf = dict(SESSION_CONF)
    if input_bytes:
        conf.update(cluster_conf(input_bytes))
    for key, value in conf.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "layerforge") -> SparkSession:
    """Session for tests and the local benchmark (UI off, no ports beyond
    the ones a local session opens itself)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LF_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_one_process(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``)."""
    return master == "local" or master.startswith("local[")


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (shared
    storage every executor can reach); a cluster session that names none is
    refused. Only a session in this one process (``local[...]``, as in tests)
    gets a fresh local folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not is_one_process(sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            current = tempfile.mkdtemp(prefix="lf-work-", dir="/tmp")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    # setCheckpointDir appends a per-application uuid folder; tables go beside it
    return current.rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, uniquely named folder under the work root for one run."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
