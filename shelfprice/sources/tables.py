"""Readers for the Parquet tables the engine runs on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """``{base_dir}/{name}.parquet``; Catalyst prunes columns and pushes filters
    into the scan, so callers select only what they use."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
