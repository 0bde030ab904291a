"""Joins and group statistics that hold when one key owns a large share of the rows.

``find_hot_keys`` counts a small sample of the key columns, which is all it reads, and stores the keys
it finds as a table ``(key, number of salts)``; there are at most as many as rows divided by
``rows_per_task``. With no hot key (the usual case) every operator here is the plain Spark plan. Hot keys
are spread over several tasks by a salt taken from the row's own columns and, so that equal copies
part too, from the number of the input partition. Both stay the same when a lost task is run again.

The sample only decides how far a key is spread. Every row goes into every result.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritally.workspace import materialize

ROWS_PER_TASK = 2_000_000
DEALT_ROWS = 500_000  # of one task where rows are dealt to a stated number of tasks: sorted twice there, about 250 bytes a row
BROADCAST_ROWS = 200_000
SAMPLE_ROWS = 4_000  # sampled rows of a key that is just hot: its count is then known within 5%
SALT = "_salt"
SALTS = "_salts"

Keys = str | Sequence[str]
Hot = DataFrame | tuple[()]  # a table of keys and salts, or () for none
NO_HOT: Hot = ()


def names(key: Keys) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def is_hot(hot: Hot) -> bool:
    return isinstance(hot, DataFrame)


def find_hot_keys(df: DataFrame, key: Keys, rows_per_task: int = ROWS_PER_TASK) -> Hot:
    """Keys with more rows than one task should hold, with the number of tasks to use, as a stored
    table; ``NO_HOT`` if there are none."""
    keys = names(key)
    fraction = min(1.0, SAMPLE_ROWS / rows_per_task)
    sample = df.select(*keys).dropna("any")
    if fraction < 1.0:
        sample = sample.sample(fraction, seed=1)
    counts = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_task * fraction)
    salts = F.ceil(F.col("n") / F.lit(fraction * rows_per_task)).cast("int").alias(SALTS)
    found = counts.select(*keys, salts)
    return NO_HOT if found.isEmpty() else materialize(found, "hot-keys")  # nearly always nothing is found, nor stored


def tasks_for(df: DataFrame, rows_per_task: int = DEALT_ROWS) -> int:
    """As many tasks as ``df`` needs for at most ``rows_per_task`` rows each, and no fewer than run at once."""
    return max(df.sparkSession.sparkContext.defaultParallelism, ceil(df.count() / rows_per_task))


def _small(table: DataFrame) -> DataFrame:
    """A table with a broadcast hint if it is short, else as it is: Spark then shuffles it."""
    return F.broadcast(table) if table.select(F.lit(1)).offset(BROADCAST_ROWS).isEmpty() else table


def add_salt(df: DataFrame, key: Keys, hot: DataFrame, spread: Sequence[str]) -> DataFrame:
    """Add the salt: 0 for most keys, a hash of the ``spread`` columns for hot ones."""
    salt = F.pmod(F.xxhash64(*spread, F.spark_partition_id()), F.col(SALTS)).cast("int")
    return (
        df.join(_small(hot), names(key), "left")
        .withColumn(SALT, F.when(F.col(SALTS).isNotNull(), salt).otherwise(F.lit(0)))
        .drop(SALTS)
    )


def replicate(df: DataFrame, key: Keys, hot: DataFrame) -> DataFrame:
    """One copy of each hot row per salt; other rows once with salt 0."""
    return (
        df.join(_small(hot), names(key), "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1)))
        .drop(SALTS)
    )


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has fixed-size columns only and at most ``max_rows`` rows.

    Looks for row ``max_rows + 1`` and stops there, so a large table is not counted.
    """
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
    narrow = all(isinstance(f.dataType, fixed) for f in df.schema.fields)
    return narrow and df.select(F.lit(1)).offset(max_rows).isEmpty()


def join_unique(
    rows: DataFrame,
    lookup: DataFrame,
    key: Keys,
    spread: Sequence[str],
    how: str = "inner",
    hot: Hot | None = None,
    keep_salt: bool = False,
    small: bool | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which has one row per ``key``.

    A lookup that ``fits_broadcast`` is broadcast; ``small`` states the answer where
    the caller knows it. Otherwise both sides are shuffled, with hot keys of ``rows``
    salted and only the few lookup rows that belong to them copied. The hint keeps
    Spark from broadcasting ``rows`` on a low size estimate. ``parts`` is the number of tasks that share a shuffled join; without it
    Spark decides.
    """
    keys = names(key)
    small = fits_broadcast(lookup) if small is None else small
    if small:
        return rows.join(F.broadcast(lookup), keys, how)
    hot = find_hot_keys(rows, keys) if hot is None else hot
    if not is_hot(hot):
        dealt = rows.repartition(parts, *keys) if parts else rows
        return dealt.hint("merge").join(lookup, keys, how)
    salted = add_salt(rows, keys, hot, spread)
    salted = salted.repartition(parts, *keys, SALT) if parts else salted
    joined = salted.hint("merge").join(replicate(lookup, keys, hot), [*keys, SALT], how)
    return joined if keep_salt else joined.drop(SALT)


def with_group_stats(
    rows: DataFrame,
    key: Keys,
    spread: Sequence[str],
    *,
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """Add per-group sums and maxima to every row of the group.

    Plain groups use one window, hence one exchange, or none when ``rows`` already
    arrives partitioned by the key. A hot group is never brought together: its
    salted parts are windowed apart, and its totals come from a pre-aggregated side
    table with one row per hot key.
    """
    keys = names(key)
    aggregates = {name: F.sum(c) for name, c in (sums or {}).items()}
    aggregates |= {name: F.max(c) for name, c in (maxima or {}).items()}
    hot = find_hot_keys(rows, keys) if hot is None else hot
    if not is_hot(hot):
        group = Window.partitionBy(*keys)
        return rows.withColumns({name: a.over(group) for name, a in aggregates.items()})

    salted = rows if SALT in rows.columns else add_salt(rows, keys, hot, spread)
    part = Window.partitionBy(*keys, SALT)
    totals = (
        rows.join(_small(hot.select(*keys)), keys, "left_semi")
        .groupBy(*keys)
        .agg(*(a.alias(f"_hot_{name}") for name, a in aggregates.items()))
        .withColumn("_is_hot", F.lit(True))
    )
    few = hot.select(F.lit(1)).offset(BROADCAST_ROWS).isEmpty()  # one row of totals per hot key
    in_hot = F.col("_is_hot").isNotNull()
    return (
        salted.withColumns({name: a.over(part) for name, a in aggregates.items()})
        .join(F.broadcast(totals) if few else totals, keys, "left")
        .withColumns(
            {name: F.when(in_hot, F.col(f"_hot_{name}")).otherwise(F.col(name)) for name in aggregates}
        )
        .drop(SALT, "_is_hot", *(f"_hot_{name}" for name in aggregates))
    )
