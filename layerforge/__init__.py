"""layerforge: layered ELT and data-quality operators on Spark DataFrames.

Raw ingest (CSV, bad-record budget) -> curated tables (normalise, cast,
keep-one dedup, enrichment joins, derived and lineage columns) -> conditional
upserts on parquet snapshots -> data-quality checks and run logs.
"""

from .context import RunContext, configure, local_session, work_root

__all__ = ["RunContext", "configure", "local_session", "work_root"]
