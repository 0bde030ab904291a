"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language on the executors; the table of log-probabilities, at most
``MATRIX_BYTES`` large, is broadcast, and texts are scored in sparse batches: the bucket numbers
of a batch are the column indices of a sparse row matrix, whose product with the dense table
is a gather and a segmented sum.

NULL, empty and letterless texts are ``und`` with score 0, and so is every text if
nothing was labelled. Ties go to the language that sorts first. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import in_arrow, sliced, texts_of

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
MATRIX_BYTES = 64 << 20
SMOOTHING = 0.5
DOCS_PER_LANGUAGE = 4_000  # expected number of labelled texts of a language to learn from
UNKNOWN = "und"
SPREAD = 1 << 30
SLACK = 5.0  # standard deviations of a text's mean that are allowed for
EVIDENCE = 30  # distinct n-grams: about a dozen letters
LEARNED = 500
POOR_FIT = -1.0  # texts of the learned languages lie around 0, those in other scripts below -2
SPACE = np.uint32(32)
MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prob: np.ndarray  # (languages, buckets + 1); the last bucket is for n-grams that do not count
    log_prior: np.ndarray

    def expected(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean and standard deviation of the log-probability of an n-gram of each language."""
        log_prob = self.log_prob[:, :-1].astype(np.float64)
        prob = np.exp(log_prob)
        mean = (prob * log_prob).sum(axis=1)
        return mean, np.sqrt(np.maximum((prob * log_prob**2).sum(axis=1) - mean**2, 1e-12))

    def judges(self) -> np.ndarray:
        """Of which languages enough was learned, ``LEARNED`` distinct n-grams, to say that a text does not fit."""
        log_prob = self.log_prob[:, :-1]
        return (log_prob > log_prob.min(axis=1, keepdims=True) + 1e-6).sum(axis=1) >= LEARNED


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, anything but letters as a space, one more space before each
    text; and where each text begins."""
    lowered = [" " + (t or "").lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered))
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(_letters()[codes], codes, SPACE)
    return codes, np.concatenate(([0], np.cumsum(sizes)[:-1]))


def hashed_ngrams(codes: np.ndarray, starts: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """For each order and code point, the bucket of the n-gram that ends there. An n-gram that
    reaches back into another text, is a single space or holds two spaces in a row gets bucket
    ``buckets``."""
    sizes = np.diff(np.append(starts, len(codes)))
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    blank = codes == SPACE
    gap = np.zeros(len(codes), dtype=bool)
    gap[1:] = blank[1:] & blank[:-1]
    for order in ORDERS:
        key = np.full(len(codes), order, dtype=np.uint32)
        void = place < order - 1 if order > 1 else blank
        for back in range(order):
            at = slice(back, None)
            key[at] = (key[at] ^ codes[: len(codes) - back]) * MULTIPLIERS[back]
            key ^= key >> np.uint32(15)
            if back < order - 1:
                void[at] |= gap[: len(codes) - back]
        yield np.where(void, np.uint32(buckets), key & np.uint32(buckets - 1)).astype(np.intp)


def _count_batches(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    counts: dict[int, np.ndarray] = {}
    for batch in sliced(batches, "text"):
        codes, starts = _code_points(texts_of(batch, "text"))
        sizes = np.diff(np.append(starts, len(codes)))
        language = np.repeat(batch.column("language").to_numpy(), sizes)
        for grams in hashed_ngrams(codes, starts, buckets):
            for k in np.unique(language):
                found = np.bincount(grams[language == k], minlength=buckets + 1)[:buckets]
                counts[int(k)] = counts.get(int(k), 0) + found
    for k, found in counts.items():
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), k, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(found[at].astype(np.int64))],
            names=["language", "bucket", "n"],
        )


def fit(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    draw_by: tuple[str, ...] = (),
    docs_per_language: int = DOCS_PER_LANGUAGE,
    smoothing: float = SMOOTHING,
) -> LanguageModel:
    """Learn from (text, label) rows. Of a language with more texts, ``docs_per_language`` are
    expected to be drawn by a hash of the text and ``draw_by``, which bounds the work; priors come
    from all rows."""
    drawn = F.pmod(F.xxhash64(F.col(text), *draw_by), F.lit(SPREAD)).alias("_drawn")
    rows = labelled.select(F.col(text).alias("text"), F.col(label).alias("label"), drawn)
    rows = rows.where("text is not null and label is not null")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(sizes))
    buckets = BUCKETS
    while len(languages) * buckets * 4 > MATRIX_BYTES:
        buckets //= 2
    if buckets < 256:
        raise ValueError(f"{len(languages)} labels are too many for language ID")
    total = max(1, sum(sizes.values()))
    prior = np.log(np.array([sizes[k] / total for k in languages] or [1.0]))
    if not languages:
        return LanguageModel((), np.zeros((0, buckets + 1), dtype=np.float32), prior)

    lookup = F.lit(list(languages))
    share = F.lit([min(SPREAD, SPREAD * docs_per_language // sizes[k]) for k in languages])
    number = F.array_position(lookup, F.col("label")).cast("int") - 1
    sample = rows.where(F.col("_drawn") < F.get(share, number)).select("text", number.alias("language"))
    counted = (
        in_arrow(sample, lambda batches: _count_batches(batches, buckets), "language int, bucket int, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # at most one row for each cell of the table
    )
    counts = np.zeros((len(languages), buckets))
    counts[counted["language"].to_numpy(), counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    counts += smoothing
    table = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    return LanguageModel(languages, np.hstack((table, np.zeros((len(languages), 1), dtype=np.float32))), prior)


def score_texts(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """The most probable language of each text and its posterior probability."""
    return score_and_fit(texts, model)[:2]


def score_and_fit(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The same, and how well the language fits: the posterior only compares the learned languages, and the least bad one of them
    is nearly certain for any longer text.

    The fit is the mean log-probability of the text's n-grams less the one that is expected in that language, in standard
    deviations of one n-gram; ``slack`` of their number is allowed for chance.
    """
    if not texts:
        return [], np.zeros(0), np.zeros(0)
    codes, starts = _code_points(texts)
    has_letter = np.add.reduceat((codes != SPACE).astype(np.int64), starts) > 0
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    total = np.tile(model.log_prior, (len(texts), 1))
    buckets = model.log_prob.shape[1] - 1
    counted = np.zeros(len(texts))
    for grams in hashed_ngrams(codes, starts, buckets):
        counted += np.add.reduceat((grams < buckets).astype(np.float64), starts)
        for i, row in enumerate(model.log_prob):
            total[:, i] += np.add.reduceat(row[grams], starts, dtype=np.float64)
    best = total.argmax(axis=1)
    top = total.max(axis=1)
    score = np.where(has_letter, 1.0 / np.exp(total - top[:, None]).sum(axis=1), 0.0)
    mean, spread = model.expected()
    some = np.maximum(counted, 1)
    fit = ((top - model.log_prior[best]) / some - mean[best]) / spread[best] + slack(some)
    fit[~model.judges()[best]] = np.inf
    return [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, has_letter)], score, fit


def slack(n: np.ndarray | int) -> np.ndarray | float:
    """By how much the fit of a text of ``n`` n-grams may be worse by chance."""
    return SLACK / np.sqrt(n)


def distinct_ngrams(text: str | None, buckets: int) -> int:
    codes, starts = _code_points([text])
    return sum(len(np.unique(g[g < buckets])) for g in hashed_ngrams(codes, starts, buckets))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*keep, lang_pred, score) for every row of ``docs``. Only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "_text"):
            names, score = score_texts(texts_of(batch, "_text"), shared.value)
            arrays = [batch.column(c) for c in keep] + [pa.array(names, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop("_text").schema)
    return in_arrow(kept, run, f"{schema}, lang_pred string, score double")


def keep_known(
    docs: DataFrame, model: LanguageModel, text: str = "text", min_score: float = 0.0, min_fit: float = -np.inf
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a language with at least ``min_score`` that fits it at least
    as well as ``min_fit``. A text of fewer than ``EVIDENCE`` distinct n-grams says too little to go for its fit."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            texts = texts_of(batch, text)
            names, score, fit = score_and_fit(texts, shared.value)
            known = [n != UNKNOWN and s >= min_score for n, s in zip(names, score)]
            buckets = shared.value.log_prob.shape[1] - 1
            for i in np.flatnonzero(np.array(known) & (fit < min_fit)):
                known[i] = distinct_ngrams(texts[i], buckets) < EVIDENCE
            yield batch.filter(pa.array(known, pa.bool_()))

    return in_arrow(docs, run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the checksum of its id; false for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learned_from(docs: DataFrame) -> LanguageModel:
    """A model of the labelled ``documents`` that are not held out; a row without id teaches nothing."""
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), draw_by=("doc_id",))


def document_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``documents``."""
    marked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(marked, learned_from(docs), keep=("doc_id", "held_out"))
