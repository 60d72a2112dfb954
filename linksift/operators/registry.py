"""Model registry as a table: version, path, cfg_hash, metrics, notes, ts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_SCHEMA = (
    "version string, path string, cfg_hash string, metrics map<string,double>, notes string, ts timestamp"
)


def entry(
    spark: SparkSession, version: str, path: str, cfg_hash: str, metrics: dict, notes: str = "", ts=None
) -> DataFrame:
    """One registry row; metrics that are not numbers are left out."""
    numeric = {
        k: float(v) for k, v in metrics.items() if isinstance(v, (int, float))
    }
    row = spark.createDataFrame([(version, path, cfg_hash, numeric, notes, ts)], REGISTRY_SCHEMA)
    return row.withColumn("ts", F.coalesce("ts", F.current_timestamp()))


def register(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Add entries; the newest entry of a version (the larger path on ties) replaces the others."""
    whole = F.struct("version", "path", "cfg_hash", "metrics", "notes", "ts")
    newest = F.max_by(whole, F.struct("ts", "path"))
    return registry.unionByName(new).groupBy("version").agg(newest.alias("_m")).select("_m.*")


def latest(registry: DataFrame) -> DataFrame:
    """The entry with the largest ts (one row), from one aggregate without a sort."""
    whole = F.struct("version", "path", "cfg_hash", "metrics", "notes", "ts")
    return registry.agg(F.max_by(whole, F.struct("ts", "version", "path")).alias("m")).filter("m IS NOT NULL").select("m.*")
