"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Lazy scan; column pruning and filters reach the Parquet reader."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
