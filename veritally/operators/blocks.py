"""Words and ids of whole blocks of rows as codes: what is looked up elsewhere is sent once per block, not per token.

A block is an Arrow batch of rows, cut off where it has ``BLOCK_TOKENS`` tokens; a longer row is a block of its own. Tokens that
the head has are coded by their id, 0 or more; the others by ``-1 - j``, where ``j`` is their place among the block's distinct ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_TOKENS = 1 << 20
BATCH_BYTES = 8 << 20  # of rows that cross between the JVM and Python at a time
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BITS = 32  # of a block's number within its partition
BLOCK, CODES, PARTS, OPEN = "_block", "_codes", "_parts_of_block", "_open"

Coded = tuple[np.ndarray, np.ndarray]  # the ids of tokens, and whether the head has them
Head = Callable[[pa.Array], Coded]


def bound_batches(df: DataFrame) -> None:
    """A batch is held by the JVM and by Python; a limit that is already lower stays."""
    conf = df.sparkSession.conf
    limit = int(conf.get(BATCH_LIMIT, str(BATCH_BYTES)).rstrip("b"))
    if not 0 < limit <= BATCH_BYTES:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_starts(sizes), pa.int32()), values)


def _cuts(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``BLOCK_TOKENS`` tokens, or one longer row."""
    first, rows = 0, len(starts) - 1
    while first < rows:
        stop = max(first + 1, int(np.searchsorted(starts, starts[first] + BLOCK_TOKENS, side="right")) - 1)
        yield first, stop
        first = stop


def code_blocks(df: DataFrame, parts: str, kept: Sequence[str], part_type: T.DataType, head: Head) -> DataFrame:
    """(*kept, _block, _codes, _parts_of_block, _open): the tokens of the array ``parts`` as codes. The first row of a block has the
    distinct tokens that the head lacks, the others have NULL; ``_open`` says whether the row has any of them."""
    bound_batches(df)
    fields = [T.StructField(f.name, f.dataType) for f in df.select(*kept).schema.fields]
    schema = T.StructType(
        [
            *fields,
            T.StructField(BLOCK, T.LongType()),
            T.StructField(CODES, T.ArrayType(T.LongType())),
            T.StructField(PARTS, T.ArrayType(part_type)),
            T.StructField(OPEN, T.BooleanType()),
        ]
    )
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << BATCH_BITS
        for batch in batches:
            starts = _starts(_sizes(batch.column(width)))
            for first, stop in _cuts(starts):
                rows = batch.slice(first, stop - first)
                sizes = _sizes(rows.column(width))
                flat = rows.column(width).flatten()
                codes, found = head(flat)
                lacking = flat.filter(pa.array(~found)).dictionary_encode()
                codes[~found] = -1 - lacking.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                misses = _starts(~found)
                bounds = _starts(sizes)
                still = misses[bounds[1:]] > misses[bounds[:-1]]
                own = [lacking.dictionary if len(lacking.dictionary) else None, *[None] * (rows.num_rows - 1)]
                listed = _lists(lacking.dictionary, np.array([len(lacking.dictionary), *[0] * (rows.num_rows - 1)]))
                listed = pc.if_else(pa.array([x is not None for x in own]), listed, pa.scalar(None, listed.type))
                columns = [rows.column(i) for i in range(width)]
                columns += [pa.array(np.full(rows.num_rows, block)), _lists(pa.array(codes), sizes), listed, pa.array(still)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, BLOCK, CODES, PARTS, OPEN])
                block += 1

    return df.select(*kept, parts).mapInArrow(run, schema)


def _take(codes: np.ndarray, known: pa.Array | None, place: np.ndarray, found: pa.Array) -> pa.Array:
    """The values of codes: ids stand for themselves if ``known`` is None, else for ``known`` at that place."""
    late = -1 - codes
    where = np.full(int(place.max()) + 1 if len(place) else 0, -1, np.int64)
    where[place] = np.arange(len(place))
    open_ = codes < 0
    at = np.full(len(codes), -1, np.int64)
    at[open_] = where[late[open_]]
    if known is not None:
        at = np.where(open_, np.where(at < 0, -1, at + len(known)), codes)
        return pa.concat_arrays([known, found]).take(pa.array(at, mask=at < 0))
    values = found.take(pa.array(at, mask=at < 0))
    return pc.if_else(pa.array(open_), values, pa.array(codes)) if open_.any() else pa.array(codes)


def fill_blocks(stored: DataFrame, found: DataFrame, value: str, kept: Sequence[str], known: pa.Array | None = None) -> DataFrame:
    """(*kept, _codes, known): codes as values. ``found`` is (_block, j, value) for every distinct token that the head lacks; a value may
    be NULL. Rows that the head settles stay where they are."""
    bound_batches(stored)
    kind = found.schema[value].dataType
    fields = [T.StructField(f.name, f.dataType) for f in stored.select(*kept, CODES).schema.fields]
    schema = T.StructType([*fields, T.StructField("known", T.ArrayType(kind))])
    arrow = pa.string() if isinstance(kind, T.StringType) else pa.int64()
    names = [*kept, CODES]

    def filled(rows: pa.RecordBatch | pa.Table, place: np.ndarray, values: pa.Array) -> list[pa.Array]:
        codes = rows.column(CODES)
        flat = codes.flatten().to_numpy(zero_copy_only=False)
        return [*(rows.column(n) for n in names), _lists(_take(flat, known, place, values), _sizes(codes))]

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = filled(batch, np.zeros(0, np.int64), pa.array([], arrow))
            yield pa.RecordBatch.from_arrays(columns, [*names, "known"])

    def of_block(rows: pa.Table, looked_up: pa.Table) -> pa.Table:
        one = rows.combine_chunks().to_batches()[0] if rows.num_rows else None
        if one is None:
            return pa.Table.from_arrays([pa.array([], f.type) for f in rows.select(names).schema] + [pa.array([], pa.list_(arrow))], [*names, "known"])
        values = looked_up.column(value).combine_chunks().cast(arrow)
        place = looked_up.column("j").to_numpy().astype(np.int64)
        return pa.Table.from_arrays(filled(one, place, values), [*names, "known"])

    whole = stored.where(~F.col(OPEN)).select(*names).mapInArrow(at_home, schema)
    partial = stored.where(F.col(OPEN)).select(*names, BLOCK)
    looked_up = found.select(F.col(BLOCK).alias("_of"), "j", value).groupBy("_of")
    return whole.unionByName(partial.groupBy(BLOCK).cogroup(looked_up).applyInArrow(of_block, schema))
