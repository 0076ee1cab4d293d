"""The driver tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder; any path that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
