"""Filter interaction audit: what each filter removes, in every order of the filters, kept up to date as files arrive.

A document's mask says which of five filters it fails, wherever these stand in an order. Four filters judge the document alone;
the fifth fails a text that a smaller id has too, so its verdict can change when a smaller id arrives later. The
stream takes the files in micro-batches. Its state has an entry per distinct text, in buckets of a few hundred by hash: the smallest
id so far and how many rows of which part have it. A row that comes with a larger id counts as a copy at once. One with a smaller id takes over: the rows that
held the text until then are retracted from the counter of their old mask and added to that of the new one. Every
micro-batch writes the change of its counters to a folder of its own, overwritten when the micro-batch is repeated.
The counters are the sums of these changes; orders, steps and Shapley values follow from them alone.

Copies of one text meet in each task before the shuffle: it passes on the smallest id, and counts of those that are larger,
which are copies whatever else arrives. So a text that owns a third of all rows sends a few rows per task, and its
state is one entry.

A NULL text is empty, like an empty one. A NULL part is the empty string. A row with a NULL id is smaller than none and larger than
none, so it is never a copy. Rows that repeat an id are told apart by nothing: with the same text, all of them hold it.
Labels may lack an id, which then meet no row, or repeat it; a label counts if any row says so. Further columns are left behind. An empty table has no part,
hence no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from veritally.llm.common import WORD, in_arrow
from veritally.workspace import fresh_path

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")

MICRO_BATCHES = 4  # over the files there are: labels and state are gone through once per micro-batch, whatever the size of the table
HELD_TEXTS = 20_000  # distinct texts that a task brings together before it passes them on
BUCKET_TEXTS = 256  # that share a row of the state: a row costs about as much as one with a single text
STATE = "digest array<string>, least array<long>, facts array<string>, n array<long>"
HEAP_ROWS = 250_000  # documents per partition of the state up to which it is kept in the heap, about 50 MB
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STORES = "org.apache.spark.sql.execution.streaming.state"
IN_HEAP = {_PROVIDER: f"{_STORES}.HDFSBackedStateStoreProvider"}
# Beyond, on the executors' disks. In either case a micro-batch stores what it changed in the checkpoint.
ON_DISK = {
    _PROVIDER: f"{_STORES}.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def own_mask(text: Column) -> Column:
    """The bits of the filters that need nothing but the text: A under 100 words, B under 80 % distinct words, C over 10 %
    capital letters, D special signs."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    words, distinct = F.size(found), F.size(F.array_distinct(found))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    failed = [
        words < 100,
        distinct.cast("long") * 100 < words.cast("long") * 80,
        capitals.cast("long") * 100 > F.length(text).cast("long") * 10,
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failed)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def bring_copies_together(judged: DataFrame, most: int = HELD_TEXTS) -> DataFrame:
    """(digest, mask, holds, id, facts, n) from rows of (digest, mask, id, facts), per task.

    Of the rows of a text that meet, those of the smallest id hold it. The others are counted as copies, whose verdict is
    final. So are rows that have no id, which are none.
    """
    schema = pa.schema([("digest", pa.string()), ("mask", pa.int32()), ("holds", pa.bool_()), ("id", pa.int64()), ("facts", pa.string()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple, int] = {}
        held: dict[tuple, Counter] = {}
        final: Counter = Counter()

        def passed_on() -> Iterator[pa.RecordBatch]:
            out = [(*text, True, least[text], facts, n) for text, rows in held.items() for facts, n in rows.items()]
            out += [(digest, mask, False, 0, facts, n) for (digest, mask, facts), n in final.items()]
            for i in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[i : i + 10_000]), schema)], schema=schema)
            for kept in (least, held, final):
                kept.clear()

        for batch in batches:
            for digest, mask, key, facts in zip(*(c.to_pylist() for c in batch.columns)):
                if key is None:
                    final[digest, mask, facts] += 1
                    continue
                text = digest, mask
                before = least.get(text)
                if before is None or key < before:
                    for other, n in held.get(text, {}).items():
                        final[digest, mask | COPY, other] += n
                    least[text], held[text] = key, Counter({facts: 1})
                elif key == before:
                    held[text][facts] += 1
                else:
                    final[digest, mask | COPY, facts] += 1
            if len(held) + len(final) >= most:
                yield from passed_on()
        yield from passed_on()

    narrow = judged.select("digest", "mask", "id", "facts")
    return in_arrow(narrow, run, "digest string, mask int, holds boolean, id long, facts string, n long")


def counter_changes(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What the rows of a bucket of texts in a micro-batch change in the counters. State: each text's smallest id and the
    rows that have it."""
    least: dict[str, int] = {}
    held: dict[str, Counter] = {}
    for digest, known, facts, n in zip(*state.get) if state.exists else ():
        least[digest] = known
        held.setdefault(digest, Counter())[facts] = n
    changes: Counter = Counter()
    for frame in frames:
        for digest, mask, holds, key, facts, n in zip(*(frame[c].tolist() for c in ("digest", "mask", "holds", "id", "facts", "n"))):
            changes[facts, mask] += n
            if not holds:
                continue
            known = least.get(digest)
            if key == known:
                held[digest][facts] += n
                continue
            if known is None or key < known:
                copies = held.get(digest, {})
                least[digest], held[digest] = key, Counter({facts: n})
            else:
                copies = {facts: n}
            for other, count in copies.items():
                changes[other, mask] -= count
                changes[other, mask | COPY] += count
    if held:
        rows = [(digest, least[digest], facts, n) for digest, counted in held.items() for facts, n in counted.items()]
        state.update(tuple(map(list, zip(*rows))))
    out = [(facts, mask, n) for (facts, mask), n in changes.items() if n]
    if out:
        yield pd.DataFrame(out, columns=["facts", "mask", "n"])


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """(digest, mask, id, facts): each row's text as a digest, its own mask, and what counters tell apart besides the mask.

    ``facts`` are the labels' digits good and toxic, then the part. Texts are left behind before ids meet their labels.
    """
    said = labels.groupBy(F.col(key).alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    blank = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(key).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"))
    narrow = blank.select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), own_mask(F.col("text")).alias("mask"), "id", "part")
    digit = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int").cast("string")
    return narrow.join(said, "id", "left").select("digest", "mask", "id", F.concat(digit("good"), digit("toxic"), "part").alias("facts"))


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def buckets_for(rows: int, texts: int = BUCKET_TEXTS) -> int:
    """Into how many buckets a table of ``rows`` rows is dealt."""
    return max(1, math.ceil(rows / texts))


def start_audit(
    docs: DataFrame, labels: DataFrame, path: str, checkpoint: str, buckets: int, store: dict[str, str] = ON_DISK, **columns: str
) -> StreamingQuery:
    """Take in all files of the stream ``docs`` that are there, and write the changes of the counters below ``path``.

    The state is kept in ``buckets`` parts, by a hash of the text: see ``buckets_for``, with the size that the table is to reach.
    Started again with the same ``checkpoint``, ``buckets`` and ``store``, the stream goes on with the files that have arrived since.
    """
    changes = (
        bring_copies_together(judge(docs, labels, **columns))
        .withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandasWithState(counter_changes, "facts string, mask int, n long", STATE, "update", GroupStateTimeout.NoTimeout)
    )

    def write(df: DataFrame, micro_batch: int) -> None:
        df.groupBy("facts", "mask").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{path}/micro_batch={micro_batch}")

    with session_settings(docs.sparkSession, store):  # read when the stream starts
        return (
            changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


def counters(spark: SparkSession, path: str) -> DataFrame:
    """(part, mask, n, good, toxic): the documents of each part and mask, from all changes written so far."""
    changes = spark.read.schema("facts string, mask int, n long, micro_batch int").parquet(path)
    sums = changes.groupBy("facts", "mask").agg(F.sum("n").alias("n")).where(F.col("n") != 0)
    among = lambda at: F.sum(F.when(F.substring("facts", at, 1) == "1", F.col("n")).otherwise(F.lit(0)))
    part = F.substring("facts", 3, 1 << 30).alias("part")
    return sums.groupBy(part, "mask").agg(F.sum("n").alias("n"), among(1).alias("good"), among(2).alias("toxic"))


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from ``counters``.

    Every counter row meets every step of every order, which are constants: the result has as many rows per
    part as there are steps, whatever the number of documents.
    """
    steps = []
    for order in map("".join, permutations(filters)):
        for i, f in enumerate(order):
            earlier = sum(1 << filters.index(x) for x in order[:i])
            steps.append(f"named_struct('filter_order', '{order}', 'step', {i + 1}, 'bit', {1 << filters.index(f)}, 'earlier', {earlier})")
    rows = counted.select("*", F.explode(F.expr(f"array({', '.join(steps)})")).alias("s")).select("*", "s.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    total = lambda when, what: F.sum(F.when(when, F.col(what)).otherwise(F.lit(0)))
    result = rows.groupBy("part", "filter_order", "step", "bit").agg(
        total(~gone & ~fails, "n").alias("kept"),
        total(~gone & fails, "n").alias("removed"),
        total(gone & fails, "n").alias("redundant"),
        total(F.col("mask") == F.col("bit"), "n").alias("unique_fails"),
        total(~gone & fails, "good").alias("good_lost"),
        total(~gone & fails, "toxic").alias("toxic_lost"),
    )
    same_filter = Window.partitionBy("part", "bit")  # one row per order
    return result.withColumn("shapley", F.sum("removed").over(same_filter)).drop("bit")


def read_documents_stream(spark: SparkSession, path: str, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """The files of a Parquet table (a folder, or one file) as a stream that takes about ``micro_batches`` turns."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    per_turn = max(1, math.ceil(files.getContentSummary(place).getFileCount() / micro_batches))
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", per_turn)
    if files.getFileStatus(place).isDirectory():
        return stream.parquet(path)
    return stream.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())


def document_audit(spark: SparkSession, documents: str, labels: DataFrame) -> DataFrame:
    """The audit of the ``documents`` table at a path, all of its files taken in by a stream."""
    path = fresh_path(spark, "filter-audit")
    stream = read_documents_stream(spark, documents)
    rows = spark.read.parquet(documents).count()  # from the files' footers
    store = IN_HEAP if rows <= HEAP_ROWS * int(spark.conf.get("spark.sql.shuffle.partitions")) else ON_DISK
    start_audit(stream, labels, f"{path}/changes", f"{path}/checkpoint", buckets_for(rows), store).awaitTermination()
    return audit(counters(spark, f"{path}/changes"))
