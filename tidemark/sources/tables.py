"""Parquet tables of a data folder (column pruning and filters reach the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(data_dir, name))
