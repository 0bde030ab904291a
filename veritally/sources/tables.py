"""Reading stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from veritally.schemas import require_columns


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table, a file or a folder of files."""
    return spark.read.parquet(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table of one of the record types in ``schemas``; fails on missing or mistyped columns."""
    return require_columns(spark.read.parquet(path), schema)
