"""Importance resampling towards a target distribution, by hashed word runs.

Words come from the pre-tokenisation of the ``tokenizers`` package: an untrained Regex Split over the text, A-Z
lower-cased, gives them with their offsets. Windows of one to three offset pairs are the features: their words, joined by one
space, are hashed by CRC-32 into a fixed number of buckets, and counted over the corpus and over the target.
A bucket's gain is the smoothed log ratio of the two, a document's weight the sum of the gains of its features. Weight
plus Gumbel noise that depends on the document's id alone ranks the documents, so the highest are a sample without
replacement that favours documents like the target.

A text is split once: its buckets are stored, two bytes per feature, and read for the counts and again for the weights. Long texts
are split in pieces that end between words, so what a task holds is bounded by its longest word. The driver gets the counts of
the buckets, whose number is fixed. The rank is a range sort of one small row per document.

A NULL or empty text has no word, weight 0 and is not drawn while ``min_words`` is above 0. A NULL id counts as an empty one. Rows that
repeat an id share its noise; ties go to the smaller id, NULL first. An empty corpus gives an empty result, an empty target
gains near zero. Further columns are left behind.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from veritally.llm.common import in_arrow, sliced, texts_of
from veritally.operators.numbering import store_in_order
from veritally.workspace import materialize

# What separates words, the longest run, the buckets and the scale of gains and scores.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST_RUN = 3
BUCKETS = 10_000
SCALE = 1000
SEED = 42
MIN_WORDS = 20
PERCENT = 5

PIECE_CHARS = 1 << 18  # of a text that is split at a time
FEATURES_SCHEMA = "n_words long, n_features long, buckets binary"


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of at least ``size`` signs, each but the last ending with a separator."""
    between = re.compile(SEPARATORS)
    start = 0
    while len(text) - start > size:
        found = between.search(text, start + size)
        if found is None:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


class WordRuns:
    """Hashes the word runs of texts."""

    def __init__(self, buckets: int = BUCKETS, piece: int = PIECE_CHARS) -> None:
        self.buckets = buckets
        self.piece = piece
        self.splitter = pre_tokenizers.Split(Regex(SEPARATORS), behavior="removed")

    def words(self, piece: str) -> list[bytes]:
        """The words of a piece, cut out by their offsets, each after a space."""
        return [b" " + piece[a:b].encode() for _, (a, b) in self.splitter.pre_tokenize_str(piece)]

    def hash(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of words, and the buckets of all runs in no particular order."""
        n, kept, tail = 0, [], []
        for piece in pieces((text or "").encode().lower().decode(), self.piece):
            new = self.words(piece)
            words = tail + new
            runs = [crc32(w[1:]) for w in words]
            kept.append(np.array(runs[len(tail) :], dtype=np.uint32))
            for length in range(2, LONGEST_RUN + 1):
                # A run one word longer goes on from the checksum of the shorter one. Runs inside the tail were counted before.
                runs = list(map(crc32, words[length - 1 :], runs))
                kept.append(np.array(runs[max(0, len(tail) - length + 1) :], dtype=np.uint32))
            n += len(new)
            tail = words[-(LONGEST_RUN - 1) :]
        return n, np.concatenate(kept) % np.uint32(self.buckets)


def hashed_runs(rows: DataFrame, text: str = "text", keep: Iterable[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """(*keep, n_words, n_features, buckets): the buckets of a text's features as 16-bit numbers in one binary value."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError(f"{buckets} buckets do not fit into 16 bits")
    keep = list(keep)
    narrow = rows.select(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keep)), F.col(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordRuns(buckets)
        for batch in sliced(batches, "text"):
            found = [hasher.hash(t) for t in texts_of(batch, "text")]
            columns = [batch.column(f"k{i}") for i in range(len(keep))]
            columns += [pa.array([n for n, _ in found], pa.int64()), pa.array([len(b) for _, b in found], pa.int64())]
            columns.append(pa.array([b.astype("<u2").tobytes() for _, b in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*(f"k{i}" for i in range(len(keep))), "n_words", "n_features", "buckets"])

    kept = "".join(f"k{i} {f.dataType.simpleString()}, " for i, f in enumerate(narrow.schema.fields[:-1]))
    out = in_arrow(narrow, run, kept + FEATURES_SCHEMA)
    return out.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keep)})


def bucket_counts(hashed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of a table fall into each bucket. Each task sends one row per bucket that it met."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for value in batch.column("buckets"):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u2"), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])], names=["bucket", "n"])

    sums = in_arrow(hashed.select("buckets"), count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of ``SCALE`` times the log of target share over corpus share, one added to every bucket."""
    size = len(corpus)
    all_corpus, all_target = float(corpus.sum() + size), float(target.sum() + size)
    ratio = lambda s, t: float(t + 1) * all_corpus / (float(s + 1) * all_target)
    return np.array([floor(SCALE * log(ratio(s, t))) for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def weigh(hashed: DataFrame, gains: np.ndarray, keep: Iterable[str]) -> DataFrame:
    """(*keep, weight): the sum of the gains of each row's features."""
    keep = list(keep)
    narrow = hashed.select(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keep)), "buckets")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(gains[np.frombuffer(v.as_buffer(), "<u2")].sum()) for v in batch.column("buckets")]
            columns = [batch.column(f"k{i}") for i in range(len(keep))] + [pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f"k{i}" for i in range(len(keep))), "weight"])

    kept = "".join(f"k{i} {f.dataType.simpleString()}, " for i, f in enumerate(narrow.schema.fields[:-1]))
    return in_arrow(narrow, run, kept + "weight long").withColumnsRenamed({f"k{i}": k for i, k in enumerate(keep)})


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise, scaled and rounded down, from a digest of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(float(-SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    target_text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) for every row of ``docs``.

    Drawn are the ``percent`` highest scores among the rows of at least ``min_words`` words; their rank counts from 1, that of
    all others is NULL.
    """
    hashed = materialize(hashed_runs(docs, text, [key], buckets), "word-runs")
    corpus = bucket_counts(hashed, buckets)
    gains = bucket_gains(corpus, bucket_counts(hashed_runs(target, target_text, (), buckets), buckets))
    scored = weigh(hashed, gains, [key, "n_words", "n_features"])
    scored = scored.withColumn("score", F.col("weight") + noise(F.col(key), seed))
    drawable = F.col("n_words") >= min_words
    order = ["_late", F.col("score").desc(), F.col(key).asc_nulls_first(), "n_features"]
    placed = store_in_order(scored.withColumn("_late", ~drawable), order, "_at")
    wanted = hashed.where(drawable).count() * percent // 100
    rank = F.when(~F.col("_late") & (F.col("_at") < wanted), F.col("_at") + 1)
    return placed.select(key, "n_words", "n_features", "weight", "score", rank.alias("rank"))


def document_resampling(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All ``documents`` scored for likeness to the ``benchmark`` texts, and the draw among them."""
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
