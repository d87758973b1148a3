"""A corpus pipeline over ``documents``: each stage applies one operator to all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetcast.llm import lines, neardup, packing, quality, substrings
from fleetcast.session import scratch_path

STAGES = [
    ("quality_rules", quality.stage),
    ("line_dedup", lines.stage),
    ("near_dedup", neardup.stage),
    ("substring_dedup", substrings.stage),
    ("packing", packing.stage),
]

# The calibrated cutoffs, near-duplicate classes and packing are not SQL; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        to = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(to)
        docs = spark.read.parquet(to)
    return docs
