"""Record of what was loaded and what was rejected, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators import gate
from cellweave.sources.listing import child_folders

OUTCOMES = (
    "run_id string, path string, dataset string, status string, reason string, dest string, "
    "rows bigint, duration_s double"
)


def rejected(decided: DataFrame, run_id: str, at: Column, taken: DataFrame | None = None) -> DataFrame:
    """Outcome records of the files the gate turned down."""
    files = gate.destinations(decided.filter(F.col("decision") == gate.REJECT), F.lit(gate.REJECTED), at, taken)
    return _shape(files, run_id, gate.REJECTED)


def loaded(decided: DataFrame, run_id: str, at: Column, taken: DataFrame | None = None) -> DataFrame:
    """Outcome records of loaded files; ``rows`` and ``duration_s`` are used when present.

    The reason of a loaded file says which of its sheets were not loaded, and how many values casts lost.
    """
    files = gate.destinations(decided.filter(F.col("decision") == gate.RUN), F.lit(gate.LOADED), at, taken)
    return _shape(files, run_id, gate.LOADED)


def append(records: DataFrame, store: str, run_id: str) -> DataFrame:
    """Keep the records of a run in the store; a run written again replaces its own. Returns the records as stored."""
    spark, part = records.sparkSession, f"{store.rstrip('/')}/run_id={run_id}"
    records.drop("run_id").write.mode("overwrite").parquet(part)
    return read(spark, store).filter(F.col("run_id") == run_id)


def taken(spark: SparkSession, store: str, run_id: str) -> DataFrame | None:
    """Archive paths in the store but for those of a run that is being repeated; None if there is no store yet."""
    if not child_folders(spark, store):
        return None
    return read(spark, store).filter(F.col("run_id").cast("string") != run_id).select("dest")


def read(spark: SparkSession, store: str) -> DataFrame:
    """All outcomes in the store."""
    return spark.read.schema(OUTCOMES).parquet(store)


def _shape(files: DataFrame, run_id: str, status: str) -> DataFrame:
    rows = F.col("rows") if "rows" in files.columns else F.lit(None)
    duration = F.col("duration_s") if "duration_s" in files.columns else F.lit(None)
    return files.select(
        F.lit(run_id).alias("run_id"),
        "path",
        "dataset",
        F.lit(status).alias("status"),
        "reason",
        "dest",
        rows.cast("long").alias("rows"),
        duration.cast("double").alias("duration_s"),
    )
