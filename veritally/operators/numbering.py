"""Exact running sums and row numbers without a one-task window.

Rows are counted per integer bucket (combined before the shuffle), the bucket
counts are summed up block by block, and rows are numbered inside their bucket.
Each window sees one block or one bucket, never the whole table. Where nothing is known of the values,
``store_in_order`` takes range partitions as buckets, whose bounds Spark samples.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritally.workspace import materialize

BLOCK = 65_536
SLOT_BITS = 33  # of a row's number within its partition in Spark's increasing ids


def running_sums(
    df: DataFrame,
    pos: str,
    values: Sequence[str],
    group: Sequence[str] = (),
    levels: int = 2,
    block: int = BLOCK,
) -> DataFrame:
    """Add ``<value>_before``: the sum of each value over smaller positions in the group.

    ``pos`` is an integer, unique within the group. A window covers at most
    ``block`` positions on every level but the last, where it covers the range of
    ``pos`` divided by ``block ** levels``.
    """
    group = list(group)
    before = [f"{v}_before" for v in values]

    def earlier(*keys: str) -> dict[str, Column]:
        w = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
        return {b: F.sum(v).over(w) for v, b in zip(values, before)}

    def no_null(cols: dict[str, Column]) -> dict[str, Column]:
        return {b: F.coalesce(c, F.lit(0).cast(df.schema[v].dataType)) for v, (b, c) in zip(values, cols.items())}

    if levels == 0:
        return df.withColumns(no_null(earlier(*group)))

    blocked = df.withColumn("_block", F.floor(F.col(pos) / block).cast("long"))
    totals = blocked.groupBy(*group, "_block").agg(*(F.sum(v).alias(v) for v in values))
    offsets = running_sums(
        totals.withColumnRenamed("_block", pos), pos, values, group, levels - 1, block
    ).select(
        *group, F.col(pos).alias("_block"), *(F.col(b).alias(f"_{b}") for b in before)
    )
    within = blocked.withColumns(no_null(earlier(*group, "_block")))
    return (
        within.join(offsets, [*group, "_block"])
        .withColumns({b: F.col(b) + F.col(f"_{b}") for b in before})
        .drop("_block", *(f"_{b}" for b in before))
    )


def number_rows(
    df: DataFrame,
    bucket: Column,
    order: Sequence[Column | str],
    out: str,
    group: Sequence[str] = (),
    levels: int = 1,
) -> DataFrame:
    """Add the 0-based position of each row in the order ``(bucket, *order)`` of its group.

    ``bucket`` must be an integer, never NULL, that grows with the wanted order and
    splits the rows into pieces one task can sort.
    """
    group = list(group)
    marked = df.withColumn("_bucket", bucket.cast("long"))
    sizes = marked.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = running_sums(sizes, "_bucket", ["_rows"], group, levels).select(
        *group, "_bucket", "_rows_before"
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    return (
        marked.join(offsets, [*group, "_bucket"])
        .withColumn(out, F.col("_rows_before") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_rows_before")
    )


def store_in_order(df: DataFrame, order: Sequence[Column | str], out: str = "pos", group: Sequence[str] = ()) -> DataFrame:
    """Store ``df`` sorted by ``(*group, *order)`` and add the 0-based position, in each group if there are any.

    Spark samples the rows for the bounds of range partitions, so these are even whatever the values look like: clustered
    values get more of them. Each task sorts one partition and numbers its rows as it writes them. What the rows of a group
    lack is the number of rows before the partition, which comes from one count per partition (and group in it).
    The rows are shuffled once and no window sees them. Rows that are equal in ``order`` share a partition and have no fixed
    order among them, so end it with a unique column.
    """
    group = list(group)
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    stored = materialize(ranged.withColumn("_slot", F.monotonically_increasing_id()), "in-order")
    placed = stored.withColumns({"_bucket": F.shiftright("_slot", SLOT_BITS), "_slot": F.col("_slot").bitwiseAND((1 << SLOT_BITS) - 1)})
    sizes = placed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first"))
    starts = running_sums(sizes, "_bucket", ["_rows"], group, levels=0)
    shift = F.col("_rows_before") - F.col("_first")
    if not group:
        starts = F.broadcast(starts)  # one row per range partition
    same = F.lit(True)
    starts = starts.select(*(F.col(g).alias(f"_{i}") for i, g in enumerate([*group, "_bucket"])), shift.cast("long").alias("_shift"))
    for i, g in enumerate([*group, "_bucket"]):
        same &= F.col(g).eqNullSafe(F.col(f"_{i}"))
    kept = [F.col(f"`{c}`") for c in df.columns]
    return placed.join(starts, same).select(*kept, (F.col("_slot") + F.col("_shift")).alias(out))


def with_position(df: DataFrame, order_col: str, out: str = "pos", group: Sequence[str] = ()) -> DataFrame:
    """0-based rank of a unique column without NULLs, gaps closed, by ``store_in_order``."""
    return store_in_order(df, [order_col], out, group)
