"""Tables stored in buckets of their key, so that joins and groupings by that key move no row.

A table is hashed into buckets once, when it is written. Spark knows the buckets of a table from its catalog, so a table
is registered under a name that follows from its folder; ``open_bucketed`` does that again in a later session.
Tables that are to meet have the same keys and number of buckets. Choose about as many buckets as a shuffle would have
partitions. With ``spark.sql.requireAllClusterKeysForCoPartition=false`` buckets of a sequence serve joins by (sequence, position).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from veritally.operators.runs import deal_runs


@dataclass(frozen=True)
class Layout:
    """Keys that rows are hashed by, number of buckets, order inside a bucket, and columns that are folders."""

    keys: Sequence[str]
    buckets: int
    order: Sequence[str] = ()
    folders: Sequence[str] = ()

    def __post_init__(self) -> None:
        if self.buckets < 1 or not self.keys:
            raise ValueError("a layout needs keys and at least one bucket")


def _name(path: str) -> str:
    return "bucketed_" + hashlib.md5(path.encode()).hexdigest()


def write_bucketed(df: DataFrame, path: str, layout: Layout) -> DataFrame:
    """Store ``df`` and return the stored table. Rows are shuffled here, once, so that each bucket is one file per folder; rows of
    numbers that lie together under one key are shuffled as one."""
    keys, order = list(layout.keys), [*layout.keys, *layout.order]
    writer = deal_runs(df, keys, layout.buckets).write.format("parquet").mode("overwrite").option("path", path)
    writer = writer.bucketBy(layout.buckets, keys[0], *keys[1:]).sortBy(order[0], *order[1:])
    if layout.folders:
        writer = writer.partitionBy(*layout.folders)
    writer.saveAsTable(_name(path))
    return df.sparkSession.table(_name(path)).select(*(f"`{c}`" for c in df.columns))


def open_bucketed(spark: SparkSession, path: str, layout: Layout, schema: T.StructType) -> DataFrame:
    """A table that ``write_bucketed`` has stored, in a session whose catalog may not know it yet."""
    listed = lambda columns: ", ".join(f"`{c}`" for c in columns)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    folders = f"partitioned by ({listed(layout.folders)})" if layout.folders else ""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"create table {name} ({columns}) using parquet {folders} clustered by ({listed(layout.keys)}) "
            f"sorted by ({listed([*layout.keys, *layout.order])}) into {layout.buckets} buckets location '{path}'"
        )
        if layout.folders:
            spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*(f"`{c}`" for c in schema.fieldNames()))
