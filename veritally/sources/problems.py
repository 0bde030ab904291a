"""The problem table: named splits, slices, counts and lookups by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.schemas import PROBLEMS, require_columns


def write_problems(problems: DataFrame, path: str) -> None:
    """Store by split, so that reading one split lists and scans only its folder."""
    (
        require_columns(problems, PROBLEMS)
        .write.mode("overwrite")
        .partitionBy("split")
        .parquet(path)
    )


def read_problems(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    problems = spark.read.schema(PROBLEMS).parquet(path).select(*PROBLEMS.fieldNames())
    return problems if split is None else load_split(problems, split)


def load_split(problems: DataFrame, split: str) -> DataFrame:
    return problems.where(F.col("split") == split)


def split_head(problems: DataFrame, split: str, n: int) -> DataFrame:
    """The first ``n`` rows of a split in stored order: a top-n per task, never a full sort."""
    return load_split(problems, split).orderBy("row_idx").limit(n)


def split_count(problems: DataFrame) -> DataFrame:
    return problems.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def row_lookup(problems: DataFrame, indices: DataFrame, column: str = "row_idx") -> DataFrame:
    """Rows whose position is in ``indices``, a one-column DataFrame that may repeat itself.

    Repeats are folded before the shuffle; Spark broadcasts the set if it is small.
    """
    wanted = indices.select(F.col(indices.columns[0]).cast("long").alias(column)).distinct()
    return problems.join(wanted, column, "left_semi")
