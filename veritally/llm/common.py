"""Helpers that several operators share: sliced Arrow batches, word hashes, id bitmaps."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"  # what the contracts call a word
SLICE_BYTES = 512 << 10  # of text that a task turns into numpy arrays at a time, or one longer text
BATCH_BYTES = 8 << 20  # of rows that cross between the JVM and Python at a time
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BITMAP_BITS = 1 << 22  # of a set of keys that is sent to all tasks: 512 KB whatever the number of keys
BROADCAST_ROWS = 500_000  # of a table of two fixed-size columns: 8 MB


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_BYTES`` (or one longer row), and free memory given back at a task's end.

    Spark holds a batch twice per running task, in the executor's JVM and in its Python worker. The limit is a setting of the
    session, read when a query runs; one that is already lower stays.
    """
    conf = df.sparkSession.conf
    limit = int(conf.get(BATCH_LIMIT).rstrip("b"))
    if not 0 < limit <= BATCH_BYTES:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))

    def run_and_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return df.mapInArrow(run_and_release, schema)


def release_memory() -> None:
    """Give memory that is no longer used back to the system: Spark keeps a Python worker for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim is not None:
        trim(0)


def sliced(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or of one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        end = np.cumsum(size.astype(np.int64) + 1)
        start = 0
        while start < batch.num_rows:
            before = end[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(end, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(column).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(key: Column, bits: int) -> list[Column]:
    """The two bits of a long hash."""
    return [F.pmod(k, F.lit(bits)) for k in (key, F.shiftright(key, 32))]


def bitmap_value(spark: SparkSession, bitmap: np.ndarray) -> Column:
    """A bitmap as a value: the plan refers to a table of one row that Spark reads once, and does not spell it out wherever it is
    used. Lambdas cannot use it as it is, only a column that has it."""
    return spark.createDataFrame(pa.table({"words": pa.array([bitmap], pa.list_(pa.int64()))})).scalar()


def is_set(words: Column, bits: int, key: Column) -> Column:
    """Whether both bits of the long hash ``key`` are set in the array of longs ``words``; false for NULL."""
    both = F.lit(True)
    for place in _places(key, bits):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, place.bitwiseAND(63).cast("int"))
        both &= bit.bitwiseAND(F.lit(1)) == 1
    return F.coalesce(both, F.lit(False))


def bitmap_of(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Two bits for each value of the long column ``key``, in an array of longs.

    The driver gets at most ``bits / 64`` rows of one long each, whatever the number of keys.
    Further keys only fill the map, so that it rules out less.
    """
    place = F.explode(F.array(*_places(F.col(key), bits)))
    words = (
        keys.where(F.col(key).isNotNull())
        .select(place.alias("place"))
        .select(F.shiftright("place", 6).cast("int").alias("at"), F.col("place").bitwiseAND(63).cast("int").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("word"))
        .toArrow()
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words["at"].to_numpy()] = words["word"].to_numpy()
    return out


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table of fixed-size columns has at most ``rows`` rows; stops counting there."""
    return df.select(F.lit(1)).offset(rows).isEmpty()


def drop_listed(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` (a long) is not in the stored table ``listed``.

    A short list is broadcast after a check of its size. A long one is joined, but only with the
    rows whose bit is set in a bitmap of fixed size, so most rows are never shuffled. Rows with
    a NULL key stay.
    """
    listed = listed.select(key).where(F.col(key).isNotNull()).distinct()
    if is_small(listed):
        return rows.join(F.broadcast(listed), key, "left_anti")
    bitmap = bitmap_of(listed.select(F.xxhash64(key).alias("h")), "h")
    maybe = F.col(key).isNotNull() & is_set(bitmap_value(rows.sparkSession, bitmap), BITMAP_BITS, F.xxhash64(F.col(key)))
    rest = rows.where(maybe).join(listed, key, "left_anti")
    return rows.where(~maybe).unionByName(rest)
