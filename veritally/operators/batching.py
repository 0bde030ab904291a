"""Batches, seeded order and position-based groups."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.operators.numbering import number_rows, with_position

SHUFFLE_HEX_DIGITS = 4
PERMUTATION_ROUNDS = 4
PRIME = (1 << 31) - 1
LONGEST_WALK = 64


def batch_of(position: Column, batch_size: int) -> Column:
    return F.floor(position / F.lit(batch_size)).cast("long")


def assign_batches(
    df: DataFrame, batch_size: int, order_col: str = "row_idx", group: Sequence[str] = ()
) -> DataFrame:
    """Consecutive blocks of ``batch_size`` rows in stored order; the last may be short."""
    numbered = with_position(df, order_col, "_position", group)
    return numbered.withColumn("batch_id", batch_of(F.col("_position"), batch_size)).drop("_position")


def seeded_shuffle(
    df: DataFrame, id_col: str, seed: int, epoch: int = 0, out: str = "shuffle_pos"
) -> DataFrame:
    """Number the rows in a random order that depends on seed, epoch and a unique id only.

    Rows are bucketed by the first hex digits of an md5 key, which spreads them
    evenly whatever the ids look like; at most 65,536 bucket counts are summed up.
    """
    shuffle_key = F.md5(F.concat(F.lit(f"{seed}:{epoch}:"), F.col(id_col).cast("string")))
    bucket = F.conv(F.substring("_shuffle_key", 1, SHUFFLE_HEX_DIGITS), 16, 10)
    return number_rows(
        df.withColumn("_shuffle_key", shuffle_key),
        bucket,
        ["_shuffle_key", id_col],
        out,
        levels=0,
    ).drop("_shuffle_key")


def permutation_keys(seed: int, epoch: int) -> list[tuple[int, int]]:
    """For each round the two summands of a square modulo a prime."""
    digests = (hashlib.md5(f"{seed}:{epoch}:{i}".encode()).digest() for i in range(PERMUTATION_ROUNDS))
    return [(int.from_bytes(d[:4], "big") % (1 << 30), int.from_bytes(d[4:8], "big") % (1 << 30)) for d in digests]


def permutation_sides(n: int) -> tuple[int, int]:
    """The sides of a rectangle with ``n`` fields and less than one row more."""
    a = isqrt(max(1, n) - 1) + 1
    return a, -(-max(1, n) // a)


def _permuted_once(x: Column, n: int, keys: Sequence[tuple[int, int]]) -> Column:
    """A bijection of the fields of the rectangle: each round moves one coordinate by a scrambled value of the other,
    which can be undone."""
    a, b = permutation_sides(n)
    one, two = x % F.lit(a), F.floor(x / F.lit(a)).cast("long")
    scrambled = lambda v, key: (v + F.lit(key[0])) * (v + F.lit(key[1])) % F.lit(PRIME)
    for i, key in enumerate(keys):
        if i % 2:
            one = (one + scrambled(two, key)) % F.lit(a)
        else:
            two = (two + scrambled(one, key)) % F.lit(b)
    return two * F.lit(a) + one


def permuted_position(position: Column, n: int, seed: int, epoch: int = 0) -> Column:
    """A random permutation of the positions 0 to ``n`` - 1 as an expression: a keyed Feistel network with cycle walking.

    A result of ``n`` or more is permuted again until it is below, which keeps the whole a bijection. That concerns one position in
    the root of ``n``, so walks are short; one beyond ``LONGEST_WALK`` steps, which does not occur up to 4,096 positions and is as
    good as impossible above, ends the query with an error.
    """
    if n >= 1 << 53:
        raise ValueError(f"{n} positions")
    keys = permutation_keys(seed, epoch)
    first = _permuted_once(position.cast("long"), n, keys)
    steps = F.sequence(F.lit(1), F.lit(LONGEST_WALK))
    walked = F.aggregate(steps, first, lambda acc, _: F.when(acc < n, acc).otherwise(_permuted_once(acc, n, keys)))
    checked = F.when(walked < n, walked).otherwise(F.raise_error(F.lit("a walk of the permutation did not end")).cast("long"))
    return F.when(first < n, first).otherwise(checked)


def permuted_batches(df: DataFrame, position: str, n: int, batch_size: int, seed: int, epoch: int = 0) -> DataFrame:
    """Add ``shuffle_pos`` and ``batch_id`` to rows with dense positions 0 to ``n`` - 1, without a sort or a shuffle.

    ``with_position`` gives such positions once; every epoch then has an order of its own for the price of a projection.
    """
    placed = df.withColumn("shuffle_pos", permuted_position(F.col(position), n, seed, epoch))
    return placed.withColumn("batch_id", batch_of(F.col("shuffle_pos"), batch_size))


def seeded_batches(
    df: DataFrame, id_col: str, batch_size: int, seed: int, epoch: int = 0
) -> DataFrame:
    return (
        seeded_shuffle(df, id_col, seed, epoch, "_position")
        .withColumn("batch_id", batch_of(F.col("_position"), batch_size))
        .drop("_position")
    )


def ordered_eval(problems: DataFrame) -> DataFrame:
    """Stored order, by a range-partitioned sort."""
    return problems.orderBy("row_idx")


def regroup(df: DataFrame, k: int, pos: str = "pos") -> DataFrame:
    """Split a stored position into a group of ``k`` consecutive rows and a place in it."""
    return df.withColumns(
        {"group_id": F.floor(F.col(pos) / k).cast("long"), "place": (F.col(pos) % k).cast("int")}
    )


def flatten_groups(df: DataFrame, k: int, pos: str = "pos") -> DataFrame:
    """The position back from group and place."""
    return df.withColumn(pos, F.col("group_id") * k + F.col("place")).drop("group_id", "place")
