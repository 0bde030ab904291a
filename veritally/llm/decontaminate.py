"""Benchmark decontamination by spaced-seed hashing.

Texts and benchmark items are sequences of lower-cased words. A seed is the hash of the words that a fixed mask
keeps out of a window; what it leaves out may differ. Seeds of training windows meet those of benchmark windows
in a join; around each hit the two sequences are laid side by side, and the hit counts if some ``SPAN`` words in a row (or
the whole item, if shorter) agree in at least ``AGREE`` of their places.

A bitmap of fixed size, filled from the benchmark's seeds, drops nearly all training windows before the join. Only hits
are shuffled, and each carries the words around it, so no text is.

Items of fewer words than the longest mask have no window for it: they are looked for whole, word by word. Texts without a
word, NULL ones among them, are no items. Rows that repeat a doc_id or an item_id count as one document or item when
overlaps are listed; when rows are dropped, each is judged by its own text. Empty tables give no hit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import bitmap_of, bitmap_value, drop_listed, is_set, unused_name
from veritally.workspace import materialize

# 1 keeps a word, 0 ignores it. Six words each, over windows of seven to nine.
MASKS = ("1110111", "11011011", "110100111")
SPAN = 13
AGREE = 0.8
REACH = 64  # words on either side of a hit that are laid side by side
SEED_BITS = 1 << 20
BROADCAST_BYTES = 64 << 20  # of benchmark seeds and the words around them; beyond, the join shuffles
ROW_BYTES = 64  # of a seed without these words
SPACES = r"[\x20\x09-\x0D]+"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once and not at each place it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Lower-cased words as hashes."""
    return F.transform(F.filter(F.split(F.lower(text), SPACES), lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(mask: str, words: Column) -> Column:
    """The seeds of one mask at places 0, 1, and so on of an array of words, as far as the mask fits."""
    kept = [i for i, bit in enumerate(mask) if bit == "1"]
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (len(mask) - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(F.lit(int(mask, 2)), w, *(F.get(words, i + k) for k in kept[1:])))


def _windows(words: Column, masks: Sequence[str], wanted: Callable[[Column], Column], reach: int) -> Column:
    """All windows whose seed is ``wanted``, as (mask, at, seed, from, around): the words within ``reach`` and where they begin.

    ``words`` is bound to a lambda variable, so that it is computed once per row.
    """
    width = F.lit(2 * reach + max(map(len, masks)))

    def of_words(ws: Column) -> Column:
        def window(mask: str, seed: Column, at: Column) -> Column:
            first = F.greatest(at - reach, F.lit(0))
            return F.struct(
                F.lit(mask).alias("mask"), at.alias("at"), seed.alias("seed"), first.alias("from"), F.slice(ws, first + F.lit(1), width).alias("around")
            )

        found = [
            F.filter(F.transform(_seeds(m, ws), lambda s, i: F.when(wanted(s), window(m, s, i))), lambda x: x.isNotNull())  # noqa: B023
            for m in masks
        ]
        return F.concat(*found)

    return _bound(words, of_words)


def benchmark_seeds(items: DataFrame, text: str, key: str, masks: Sequence[str], least: int = 1) -> DataFrame:
    """(item, item_words, mask, seed, item_at, item_from, item_around) for the windows of every item of ``least`` words or more.

    An item shorter than the longest mask has one window, all of it, by a mask that ignores nothing.
    """
    longest = max(map(len, masks))
    rows = items.select(F.col(key).alias("item"), words(F.col(text)).alias("_words"))
    rows = rows.where(F.size("_words") >= least).groupBy("item").agg(F.max("_words").alias("_words"))
    rows = rows.withColumn("item_words", F.size("_words"))
    found = rows.select("item", "item_words", F.explode(_windows(F.col("_words"), masks, lambda _: F.lit(True), REACH)).alias("w"))
    found = found.select("item", "item_words", "w.*")
    whole = F.coalesce(*(F.when(F.col("item_words") == n, F.get(_seeds("1" * n, F.col("_words")), F.lit(0))) for n in range(1, longest)))
    short = rows.where(F.col("item_words") < longest).select(
        "item", "item_words", F.expr("repeat('1', item_words)").alias("mask"), F.lit(0).alias("at"), whole.alias("seed"),
        F.lit(0).alias("from"), F.col("_words").alias("around"),
    )
    found = found.where(F.col("item_words") >= longest)
    return found.unionByName(short).withColumnsRenamed({c: f"item_{c}" for c in ("at", "from", "around")})


def _agreement(ours: Column, theirs: Column, offset: Column, span: int) -> Column:
    """The most places in which ``span`` neighbouring words agree. ``theirs`` lies along ``ours`` from ``offset`` (0-based, may be
    negative) on; with fewer than ``span`` words in ``theirs``, all of it counts."""
    same = F.transform(theirs, lambda w, i: F.when(F.get(ours, offset + i) == w, F.lit(1)).otherwise(F.lit(0)))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("at"))

    def most(bits: Column) -> Column:
        def slide(acc: Column, x: Column) -> Column:
            left = F.when(acc["at"] >= span, F.get(bits, acc["at"] - span)).otherwise(F.lit(0))
            now = acc["now"] + x - left
            return F.struct(now.alias("now"), F.greatest(acc["best"], now).alias("best"), (acc["at"] + 1).alias("at"))

        return F.aggregate(bits, start, slide, lambda acc: acc["best"])

    return _bound(same, most)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    masks: Sequence[str] = MASKS,
    span: int = SPAN,
    agree: float = AGREE,
    least: int = 1,
) -> DataFrame:
    """(doc_id, item_id, agreeing, of_words, doc_at, item_at) for every document and item that overlap: the best agreement
    found, out of how many words, and the first place of a hit with it.

    Items of fewer than ``least`` words are left out; by default none but empty ones.
    """
    seeds = materialize(benchmark_seeds(items, item_text, item_key, masks, least), "seeds")
    held = seeds.agg(F.collect_set("mask"), F.sum(F.size("item_around") * 8 + ROW_BYTES)).first()
    shapes, size = sorted(held[0]) or list(masks), held[1] or 0
    bitmap = bitmap_value(docs.sparkSession, bitmap_of(seeds, "seed", SEED_BITS))
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"), bitmap.alias("_held"))
    likely = _windows(words(F.col("_text")), shapes, lambda seed: is_set(F.col("_held"), SEED_BITS, seed), REACH)
    likely = texts.select("doc_id", F.explode(likely).alias("w")).select("doc_id", "w.*").drop("mask")
    seeds = seeds.drop("mask")
    hits = likely.join(F.broadcast(seeds) if size <= BROADCAST_BYTES else seeds.hint("merge"), "seed")
    # Word j of item_around lies beside word at - item_at + item_from + j of the text.
    offset = F.col("at") - F.col("item_at") + F.col("item_from") - F.col("from")
    scored = hits.withColumns(
        {
            "agreeing": _agreement(F.col("around"), F.col("item_around"), offset, span),
            "of_words": F.least(F.lit(span), F.col("item_words")),
        }
    ).where(F.col("agreeing") >= F.col("of_words") * F.lit(agree))
    best = F.min_by(
        F.struct("agreeing", "of_words", F.col("at").alias("doc_at"), "item_at"), F.struct(-F.col("agreeing"), "at", "item_at")
    )
    return (
        scored.groupBy("doc_id", F.col("item").alias("item_id"))
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.agreeing", "best.of_words", "best.doc_at", "best.item_at")
    )


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without those that overlap a benchmark item, all columns as they are.

    Rows are told apart by a hash of key and text: of rows that share a key or have none, only those that overlap go.
    """
    name = unused_name(docs, "_row")
    marked = docs.withColumn(name, F.xxhash64(F.col(key), F.col(text)))
    leaked = materialize(find_leaks(marked, items, text=text, key=name, **options).select("doc_id").distinct(), "leaked")
    return drop_listed(marked, leaked.withColumnRenamed("doc_id", name), name).drop(name)


def document_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Every pair of a row of ``documents`` and a ``benchmark`` item that overlap."""
    return find_leaks(docs, items)
