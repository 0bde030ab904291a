"""Mixing sources to target weights by a curriculum that varies over training time.

Training time runs from 0 to 1. Each source has a share of all words, its target, and a schedule: how its
demand is spread over time. The demand up to time t is the integral of the schedule. A source's documents, in
an order fixed by a checksum, fill that demand one after another, again from the start when all are
used; a document's training position is the time at which the demand reaches it: the inverse
of the integral. Sorted by position, the documents are the training order.

Targets are water-filled: no source gets more than ``cap`` times its words, what is too much goes to the
others by weight. Documents are taken whole, so the words taken differ from the target by less than half
of one document, and none is taken more than ``ceil(cap)`` times.

A NULL text has size 0, a NULL source is a source of its own, after all others. Rows that repeat a doc_id are documents of
their own, told apart by their size; equal ones share their place. A document of size 0 is taken as often as
those around it. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.common import WORD, drop_listed, unused_name
from veritally.workspace import materialize

WEIGHTS = (5, 2, 1)
CAP = 3
# The demand of a source at time 0 and at time 1 relative to its mean; linear between. By turns like the weights:
# heavy sources keep their pace, the next ones come late, light ones early.
SLOPES = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))
PART_ROWS = 65_536  # documents of a part of the checksums, in which a source is summed up


def part_digits(rows: int) -> int:
    """How many hex digits of the checksum make a part."""
    return max(3, ceil(log(max(1, rows) / PART_ROWS, 16)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_rank, source_size, target) from (source, size): one row per source.

    The level of the water-filling is found by running sums over the sources, sorted by the level at
    which each is full; this window has one row per source, not per document.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("source_rank", F.row_number().over(by_name) - 1)
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod("source_rank", F.lit(len(weights))))
    filled = ranked.withColumns({"_weight": weight, "_limit": F.col("source_size") * F.lit(float(cap))})
    level = Window.orderBy(F.col("_limit") / F.col("_weight"), "source_rank")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    rest = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    candidate = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    ) / F.sum("_weight").over(rest)
    fits = F.col("_level") <= F.col("_limit") / F.col("_weight")
    return (
        filled.withColumn("_level", candidate)
        .withColumn("_level", F.max(F.when(fits, F.col("_level"))).over(everything))
        .select("source", "source_rank", "source_size", F.least(F.col("_limit"), F.col("_level") * F.col("_weight")).alias("target"))
    )


def position(share: Column, start: Column, end: Column) -> Column:
    """The time at which a schedule that goes linearly from ``start`` to ``end`` (mean 1) has met ``share`` of its demand."""
    slope = end - start
    root = F.sqrt(start * start + F.lit(2.0) * slope * share)
    return F.least(F.lit(1.0), F.when(F.abs(slope) < 1e-12, share).otherwise((root - start) / slope))


def plan_mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    cap: float = CAP,
    slopes: Sequence[tuple[float, float]] = SLOPES,
    mark: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, positions) of every row of ``docs``, and its column ``mark``.

    ``positions`` has one training position per copy, none if the document is not taken. Texts are read once: their sizes are
    stored, and only ids and sizes are shuffled. A source is summed up in parts by checksum, more of them the more documents
    there are, so one that owns most documents is spread over all tasks.
    """
    carried = [F.col(mark).alias("mark")] if mark else []
    sized = docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), *carried
    ).withColumn("_order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    sized = materialize(sized, "sizes")
    placed = sized.withColumn("_part", F.substring("_order", 1, part_digits(sized.count())))
    sums = placed.groupBy("source", "_part").agg(F.sum("size").alias("_part_size"))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_part_size").over(earlier), F.lit(0)))
    targets = source_targets(sized, weights, cap).withColumnRenamed("source", "_source")
    offsets = offsets.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_part_size")
    offsets = offsets.withColumnsRenamed({"source": "_source", "_part": "_at"})
    inside = Window.partitionBy("source", "_part").orderBy("_order", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = within.join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_at")))

    # The middle of copy k lies at middle + k * source_size of the source's demand; it is taken if the target reaches that far.
    middle = F.col("_offset") + F.col("_before") + F.col("size") / 2.0
    copies = F.greatest(F.lit(0), F.ceil(F.try_divide(F.col("target") - F.col("_middle"), F.col("source_size"))))
    copies = F.when(F.col("source_size") > 0, F.least(copies, F.lit(ceil(cap)))).otherwise(F.lit(1)).cast("long")
    at_rank = lambda values: F.get(F.lit([float(v) for v in values]), F.pmod("source_rank", F.lit(len(values))))
    start, end = (at_rank([s[i] for s in slopes]) for i in (0, 1))

    def place(k: Column) -> Column:
        share = F.try_divide(F.col("_middle") + k * F.col("source_size"), F.col("target"))
        return position(F.coalesce(share, F.lit(0.0)), F.col("_start"), F.col("_end"))

    numbers = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies").cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return (
        joined.withColumns({"_middle": middle, "_start": start, "_end": end})
        .withColumn("copies", copies)
        .withColumns({"taken": F.col("copies") * F.col("size"), "positions": F.transform(numbers, place)})
        .select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "positions", *(["mark"] if mark else []))
    )


def _planned_and_mixed(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """The stored plan of the mix, its rows numbered, and the mix: (row, _number, _position) of every copy, range-sorted by
    position."""
    name = unused_name(docs, "_row")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn(name, F.xxhash64(*columns, *(c.isNull() for c in columns)))
    planned = plan_mix(marked, mark=name, **options).withColumn("_number", F.monotonically_increasing_id())
    planned = materialize(planned, "positions")
    repeated = planned.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark")
    repeated = materialize(repeated, "repeated")
    rows = marked.select(F.col(name).alias("mark"), F.struct(*columns).alias("row"))
    if not repeated.isEmpty():
        several = rows.join(repeated, "mark", "left_semi").groupBy("mark").agg(F.first("row").alias("row"))
        rows = drop_listed(rows, repeated, "mark").unionByName(several)
    taken = planned.where(F.size("positions") > 0).select("mark", "_number", F.col("doc_id").alias("_id"), "positions")
    copies = rows.hint("merge").join(taken, "mark").select("row", "_number", "_id", F.explode("positions").alias("_position"))
    by_time = ["_position", "_id"]
    return planned, copies.repartitionByRange(*by_time).sortWithinPartitions(*by_time).drop("_id")


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, all columns as they are, range-sorted by position.

    Rows get their positions by a hash of all their columns. Rows that are equal in all of them are taken for each other: one
    of them stands for all when they meet their positions.
    """
    return _planned_and_mixed(docs, **options)[1].select("row.*")


def document_mix(docs: DataFrame) -> DataFrame:
    """The mix of all ``documents`` at the default weights, counted per document: ``taken`` are the words of its copies as they
    stand in the training order, ``position`` is that of the first copy.

    Of the mix, the sizes of its copies and their positions are stored, in training order.
    """
    planned, mixed = _planned_and_mixed(docs)
    mixed = materialize(mixed.select("_number", "_position", word_count(F.col("row.text")).alias("_words")), "mix")
    counted = mixed.groupBy("_number").agg(F.sum("_words").alias("_taken"), F.min("_position").alias("_first"))
    return planned.join(counted, "_number", "left").select(
        "doc_id",
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        F.coalesce("_taken", F.lit(0).cast("long")).alias("taken"),
        F.round("_first", 9).alias("position"),
    )
