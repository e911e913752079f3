"""Parquet table access shared by all queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data set directory; columns are pruned and filters pushed by Catalyst."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
