"""Rows that follow one another under one key as one row of arrays, for the way through a shuffle.

A run never leaves its Arrow batch, so it is as short as a batch at most, and a key comes again with its next run. Where rows of a
key do not lie together runs are short; the rows that come out are the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritally.operators.blocks import bound_batches
from veritally.operators.skew import Keys, names

FIXED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType)
HASHED = re.compile(r"hashpartitioning\(((?:\w+#\d+L?, )+)(\d+)\)")


def parts_by(df: DataFrame, key: Keys) -> int | None:
    """How many partitions ``df`` has if it arrives hashed by columns of ``key``, in buckets, dealt by ``repartition`` or out of a
    join by them; else None. Only the plan is looked at: that of a scan before Spark drops buckets without a use, that of a join after
    its exchanges are there."""
    keys = set(names(key))
    execution = df._jdf.queryExecution()
    final = execution.executedPlan()
    if final.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        final = final.initialPlan()
    told = [final.outputPartitioning().toString()]
    with suppress(IllegalArgumentException):  # the sides of a join without its exchanges need not be as many
        told.append(execution.sparkPlan().outputPartitioning().toString())
    found = [(columns, int(n)) for t in told for columns, n in HASHED.findall(t)]
    return next((n for columns, n in found if set(re.findall(r"(\w+)#", columns)) <= keys), None)


def can_pack(df: DataFrame, key: Keys) -> bool:
    """Whether the columns beside the key are numbers, and there are some."""
    rest = [f.dataType for f in df.schema.fields if f.name not in names(key)]
    return bool(rest) and all(isinstance(t, FIXED) for t in rest)


def pack_runs(df: DataFrame, key: Keys) -> DataFrame:
    """(*key, an array of each further column), one row per run. A NULL in a key is a run of its own. The function that tasks
    run stands by itself: they need not import this package."""
    bound_batches(df)
    keys = names(key)
    rest = [c for c in df.columns if c not in keys]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in keys] + [T.StructField(c, T.ArrayType(kinds[c])) for c in rest])
    width = len(keys)

    def starts(found: list[pa.Array], rows: int) -> np.ndarray:
        """Where runs begin, and the end."""
        new = np.zeros(rows - 1, bool)
        for c in found:
            new |= pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, rows - 1)), True).to_numpy(zero_copy_only=False)
        return np.concatenate([[0], np.flatnonzero(new) + 1, [rows]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bounds = starts(batch.columns[:width], batch.num_rows)
            first, offsets = pa.array(bounds[:-1]), pa.array(bounds, pa.int32())
            listed = [pa.ListArray.from_arrays(offsets, c) for c in batch.columns[width:]]
            yield pa.RecordBatch.from_arrays([*(c.take(first) for c in batch.columns[:width]), *listed], [*keys, *rest])

    return df.select(*keys, *rest).mapInArrow(run, schema)


def unpack_runs(packed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``pack_runs`` again; ``columns`` names its arrays. Partitions stay as they are."""
    others = [c for c in packed.columns if c not in columns]
    return packed.select(*others, F.inline(F.arrays_zip(*columns)))


def deal_runs(df: DataFrame, key: Keys, parts: int) -> DataFrame:
    """``df`` in ``parts`` partitions by ``key``. Rows that lie together are shuffled as one, with their key once."""
    keys = names(key)
    if not can_pack(df, keys):
        return df.repartition(parts, *keys)
    rest = [c for c in df.columns if c not in keys]
    return unpack_runs(pack_runs(df, keys).repartition(parts, *keys), rest).select(*df.columns)
