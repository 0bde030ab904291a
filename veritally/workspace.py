"""The shared folder for checkpoints, stream state and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_FILE = 1 << 18  # of a few numbers each, where ``materialize`` is told how many rows come

_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; set here only on a local master without one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="veritally-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that are stored inside the block are deleted at its end. DataFrames made from them can
    be read only inside, so write results before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str = "table", most: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What follows neither repeats the work nor depends on executors that may be lost,
    reads only the columns it needs, and Spark knows the true size for its joins.

    ``most`` is a number of narrow rows that ``df`` does not exceed. Its last stage then has no more tasks than those call for,
    since every file has its cost, on a local disk two more processes beside the executor's. Rows are all written in any case.
    """
    if most is not None:
        df = df.coalesce(max(1, -(-most // ROWS_PER_FILE)))
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
