"""Operators on token sequences that need other rows: batch padding and the vocabulary."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritally.functions.tokens import drop_special, pad_right
from veritally.operators.blocks import BLOCK, CODES, OPEN, PARTS, Coded, Head, code_blocks, fill_blocks
from veritally.operators.numbering import number_rows
from veritally.operators.skew import NO_HOT, Hot, join_unique, with_group_stats
from veritally.workspace import materialize

FIRST_TOKEN_ID = 1  # 0 is kept for padding
HEAD_WORDS = 65_536
KEY_CHARS = 64
NULL_KEYS = 1024  # rows without a token are spread over this many keys that match nothing


def pad_to_batch_max(
    df: DataFrame,
    pad_id: int,
    spread: Sequence[str],
    batch: str = "batch_id",
    ids: str = "input_ids",
    mask: str = "attention_mask",
    hot: Hot | None = None,
) -> DataFrame:
    """Right-pad ids and mask to the longest sequence of their batch."""
    longest = with_group_stats(df, batch, spread, maxima={"_longest": F.size(ids)}, hot=hot)
    return longest.withColumns(
        {
            ids: pad_right(F.col(ids), pad_id, F.col("_longest")),
            mask: pad_right(F.col(mask), 0, F.col("_longest")),
        }
    ).drop("_longest")


def words(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, pos, word), split at single spaces; a NULL text keeps one row without a word."""
    return df.select(key, F.posexplode_outer(F.split(text, " ")).alias("pos", "word"))


def build_vocabulary(tokens: DataFrame) -> DataFrame:
    """(word, n, token_id), most frequent word first; ties follow the md5 of the word.

    Words are counted before the shuffle, so frequent ones cost nothing extra. The
    md5 order lets the huge group of words seen once be numbered in even pieces.
    """
    counted = (
        tokens.where(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = materialize(counted, "word-counts")  # the texts are read once
    counted = counted.withColumn("_md5", F.unhex(F.md5("word")))  # half as long to move as its digits, in the same order
    pieces = 16**3
    bucket = -F.col("n") * pieces + F.conv(F.substring(F.hex("_md5"), 1, 3), 16, 10).cast("long")
    return number_rows(counted, bucket, ["_md5", "word"], "token_id", levels=2).select(
        "word", "n", (F.col("token_id") + FIRST_TOKEN_ID).cast("bigint").alias("token_id")
    )


def _word_key(word: Column) -> Column:
    """The word, or a digest of it where it is long, so that a key has a known largest size."""
    return F.when(F.length(word) <= KEY_CHARS, word).otherwise(
        F.concat(F.lit("\u0000"), F.sha2(word, 256))
    )


def encode_words(
    tokens: DataFrame, vocabulary: DataFrame, key: str, hot: Hot | None = NO_HOT, head_words: int = HEAD_WORDS
) -> DataFrame:
    """(key, ids) with the ids in text order; a word outside the vocabulary gets NULL.

    The head of the vocabulary, at most ``head_words`` keys of at most
    ``KEY_CHARS`` + 1 characters, is broadcast and settles nearly all tokens where
    they are read. A word past the head owns less than one token in ``head_words``
    of the corpus, so the shuffle join that settles the rest has no hot key. That
    holds for the vocabulary of the same corpus; with another one pass ``hot=None``
    to have hot words looked for.
    """
    no_word = F.concat(F.lit("\u0001"), F.pmod(F.xxhash64(key), F.lit(NULL_KEYS)).cast("string"))
    keyed = tokens.withColumn("_key", F.coalesce(_word_key(F.col("word")), no_word))
    ids = vocabulary.select(_word_key(F.col("word")).alias("_key"), "token_id")
    head = ids.where(F.col("token_id") < FIRST_TOKEN_ID + head_words)
    tail = ids.where(F.col("token_id") >= FIRST_TOKEN_ID + head_words)
    frequent = keyed.join(F.broadcast(head), "_key")
    others = keyed.join(F.broadcast(head.select("_key")), "_key", "left_anti")
    rest = join_unique(others, tail, "_key", [key, "pos"], how="left", hot=hot, small=False)
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "token_id"))
    return (
        frequent.select(key, "pos", "token_id")
        .unionByName(rest.select(key, "pos", "token_id"))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(entry))["token_id"].alias("ids"))
    )


def decode_ids(
    sequences: DataFrame,
    vocabulary: DataFrame,
    key: str,
    special_ids: list[int],
    ids: str = "ids",
    hot: Hot | None = NO_HOT,
) -> DataFrame:
    """(key, text): words joined by single spaces, special ids left out.

    As in ``encode_words``, an id past the head of its own corpus cannot be hot; for another corpus pass ``hot=None``.
    """
    tokens = sequences.select(
        key, F.posexplode_outer(drop_special(F.col(ids), special_ids)).alias("pos", "token_id")
    )
    no_token = -F.pmod(F.xxhash64(key), F.lit(NULL_KEYS)) - 1
    tokens = tokens.withColumn("token_id", F.coalesce("token_id", no_token).cast("bigint"))
    head = vocabulary.where(
        (F.col("token_id") < FIRST_TOKEN_ID + HEAD_WORDS) & (F.length("word") <= KEY_CHARS)
    ).select("token_id", "word")
    frequent = tokens.join(F.broadcast(head), "token_id")
    rest = tokens.join(F.broadcast(head.select("token_id")), "token_id", "left_anti")
    others = join_unique(
        rest, vocabulary.select("token_id", "word"), "token_id", [key, "pos"], how="left", hot=hot, small=False
    )
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "word"))
    return (
        frequent.select(key, "pos", "word")
        .unionByName(others.select(key, "pos", "word"))
        .groupBy(key)
        .agg(F.array_join(F.array_sort(F.collect_list(entry))["word"], " ").alias("text"))
    )


def _head_ids(vocabulary: DataFrame, head_words: int) -> Head:
    """Looks words up in the head by their ``_word_key``. At most ``head_words`` keys of bounded length reach the driver, and go to the tasks with the code."""
    head = vocabulary.where(F.col("token_id") < FIRST_TOKEN_ID + head_words).select(_word_key(F.col("word")).alias("key"), "token_id").collect()
    keys, ids = [r["key"] for r in head], [r["token_id"] for r in head]

    def at_home(words: pa.Array) -> Coded:
        long = pc.greater(pc.utf8_length(words), KEY_CHARS)
        if pc.any(long).as_py():
            digests = ["\u0000" + hashlib.sha256(w.as_py().encode()).hexdigest() for w in words.filter(long)]
            words = pc.replace_with_mask(words, long, pa.array(digests, words.type))
        place = pc.index_in(words, value_set=pa.array(keys, words.type))
        found = pc.is_valid(place).to_numpy(zero_copy_only=False)
        codes = np.zeros(len(words), np.int64)
        codes[found] = np.array(ids, np.int64)[place.drop_null().to_numpy()]
        return codes, found

    return at_home


def _head_words(vocabulary: DataFrame, head_words: int) -> list[str | None]:
    """The words of the head by their id; NULL for one that is too long for it."""
    rows = vocabulary.where((F.col("token_id") < FIRST_TOKEN_ID + head_words) & (F.length("word") <= KEY_CHARS)).select("token_id", "word").collect()
    words_by_id: list[str | None] = [None] * (max((r["token_id"] for r in rows), default=0) + 1)
    for r in rows:
        words_by_id[r["token_id"]] = r["word"]
    return words_by_id


def _known_ids(words_by_id: list[str | None]) -> Head:
    """Says which ids are in the head."""
    known = np.array([w is not None for w in words_by_id])

    def at_home(ids: pa.Array) -> Coded:
        codes = ids.to_numpy(zero_copy_only=False).astype(np.int64)
        inside = (codes >= 0) & (codes < len(known))
        return codes, inside & known[np.where(inside, codes, 0)]

    return at_home


def _fill_in(
    stored: DataFrame, key: str, keep: Sequence[str], lookup: DataFrame, found: str, hot: Hot, part: Callable[[Column], Column] = lambda c: c, known: pa.Array | None = None
) -> DataFrame:
    """(key, *keep, known) of rows from ``code_blocks``, with ``known`` completed from ``lookup`` of (part, found).

    The distinct unknown parts of each block become rows. What is found of them goes back to the block's rows, which meet there.
    Should a key come more than once in spite of the contract, its rows have what is found for all of them.
    """
    parts = stored.where(F.col(PARTS).isNotNull()).select(BLOCK, F.posexplode(PARTS).alias("j", "part"))
    parts = parts.withColumn("part", part(F.col("part")))
    matched = join_unique(parts, lookup, "part", [BLOCK, "j"], how="left", hot=hot, small=False)
    done = fill_blocks(stored, matched, found, [key, *keep], known)
    again = stored.where(F.col(OPEN)).groupBy(F.col(key).alias("_back")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if again.isEmpty():
        return done.drop(CODES)
    again = materialize(again.drop("n"), "keys-again")
    same = F.col(key).eqNullSafe(F.col("_back"))
    places = F.transform("known", lambda x, i: F.struct(i.alias("pos"), x.alias("found"), F.get(CODES, i).alias("code")))
    entry = lambda e: F.struct(e["pos"].alias("pos"), e["found"].alias("found"))
    early = F.transform(F.filter(places, lambda e: e["code"] >= 0), entry)
    late = F.transform(F.filter(places, lambda e: e["code"] < 0), entry)
    mine = done.join(again, same)
    all_late = mine.groupBy("_back").agg(F.flatten(F.collect_list(late)).alias("_late"))
    merged = F.transform(F.array_sort(F.concat(early, F.when(F.size(late) > 0, F.col("_late")).otherwise(late))), lambda e: e["found"])
    shared = mine.drop("_back").join(all_late, same).select(key, *keep, merged.alias("known"))
    return done.join(again, same, "left_anti").drop(CODES).unionByName(shared)


def encode_rows(
    df: DataFrame,
    key: str,
    text: Column,
    vocabulary: DataFrame,
    carry: Sequence[str] = (),
    max_words: int | None = None,
    hot: Hot = NO_HOT,
    head_words: int = HEAD_WORDS,
) -> DataFrame:
    """(key, *carry, ids): each text's words, split at single spaces and cut off after ``max_words``, as ids in text order.

    The words of the head are encoded inside the row. Of what is left, words past the head, the distinct ones of each block of rows
    are shuffled, and so are the coded rows that have some. A word outside the vocabulary gets NULL, a NULL text
    no id. ``key`` is unique. The coded rows are stored, so texts are read once. For hot words past the head see ``encode_words``.
    """
    parts = F.coalesce(F.split(text, " "), F.array().cast("array<string>"))
    if max_words is not None:
        parts = F.slice(parts, 1, max_words)
    keyed = df.select(key, *carry, parts.alias("_parts"))
    encoded = code_blocks(keyed, "_parts", [key, *carry], T.StringType(), _head_ids(vocabulary, head_words))
    tail = vocabulary.where(F.col("token_id") >= FIRST_TOKEN_ID + head_words)
    tail = tail.select(_word_key(F.col("word")).alias("part"), "token_id")
    done = _fill_in(materialize(encoded, "encoded"), key, carry, tail, "token_id", hot, _word_key)
    return done.withColumnRenamed("known", "ids")


def decode_rows(
    sequences: DataFrame,
    vocabulary: DataFrame,
    key: str,
    special_ids: list[int],
    ids: str = "ids",
    hot: Hot = NO_HOT,
    head_words: int = HEAD_WORDS,
) -> DataFrame:
    """(key, text): the way back, words joined by single spaces, special ids and those outside the vocabulary left out."""
    words_by_id = _head_words(vocabulary, head_words)
    kept = sequences.select(key, F.coalesce(drop_special(F.col(ids).cast("array<bigint>"), special_ids), F.array().cast("array<bigint>")).alias("_ids"))
    decoded = code_blocks(kept, "_ids", [key], T.LongType(), _known_ids(words_by_id))
    rest = vocabulary.where((F.col("token_id") >= FIRST_TOKEN_ID + head_words) | (F.length("word") > KEY_CHARS))
    rest = rest.select(F.col("token_id").alias("part"), "word")
    done = _fill_in(materialize(decoded, "decoded"), key, [], rest, "word", hot, known=pa.array(words_by_id, pa.string()))
    return done.select(key, F.array_join("known", " ").alias("text"))
