import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritally.llm import resampling

DOCS = "doc_id long, text string"
TARGET = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lowered)
    return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def by_counting(docs, items):
    """The contract, word for word."""
    count = lambda texts: Counter(crc32(f.encode()) % 10_000 for t in texts for f in features(t)[1])
    s, t = count([x for _, x in docs]), count([x for _, x in items])
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log(float(t[b] + 1) * float(big_s + 10_000) / (float(s[b] + 1) * float(big_t + 10_000))))

    rows, eligible = {}, []
    for d, text in docs:
        n, found = features(text)
        weight = sum(gain(crc32(f.encode()) % 10_000) for f in found)
        h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows[d] = [len(found), weight, score, None]
        if n >= 20:
            eligible.append((-score, d))
    for i, (_, d) in enumerate(sorted(eligible)[: 5 * len(eligible) // 100]):
        rows[d][3] = i + 1
    return rows


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = ["Straße", "ÉCOLE", "x1", "the", "The", "٣", "naïve", "a", "b", "c", "data", " ", "😀"]
    glue = [" ", ", ", "\n", "-", "_", "\x00", "\x7f", "[", "{"]
    make = lambda: "".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.randint(0, 60)))
    return [(i, rng.choice([None, "", make(), make(), make(), make()])) for i in range(n)]


def test_as_counted(spark):
    docs, items = corpus(1), corpus(2, 20)
    got = resampling.document_resampling(spark.createDataFrame(docs, DOCS).withColumn("score", F.lit("clash")), spark.createDataFrame(items, TARGET))
    assert {r[0]: list(r[1:5]) for r in got.collect()} == by_counting(docs, items)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6


def test_given_tables(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {r[0]: list(r[1:5]) for r in resampling.document_resampling(docs, items).collect()}
    plain = by_counting([(r["doc_id"], r["text"]) for r in docs.collect()], [(0, r["text"]) for r in items.collect()])
    assert got == plain


@pytest.mark.parametrize("size", [1, 7, 50])
def test_pieces_change_nothing(size):
    for _, text in corpus(4, 60):
        n, found = features(text)
        got_n, buckets = resampling.WordRuns(piece=size).hash(text)
        assert got_n == n
        assert sorted(buckets.tolist()) == sorted(crc32(f.encode()) % 10_000 for f in found)
        assert "".join(resampling.pieces(text or "", size)) == (text or "")


def test_likeness_to_the_target_is_drawn(spark):
    """Documents made of the target's words are drawn first where nothing else tells them apart."""
    rng = random.Random(5)
    word = lambda kind: f"{kind}{rng.randint(0, 30)}"
    docs = [(i, " ".join(word("t" if i % 20 == 0 else "o") for _ in range(40))) for i in range(600)]
    items = [(i, " ".join(word("t") for _ in range(50))) for i in range(20)]
    got = resampling.document_resampling(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, TARGET)).collect()
    drawn = sorted((r["rank"], r["doc_id"]) for r in got if r["rank"] is not None)
    assert [k for k, _ in drawn] == list(range(1, 31)) and all(d % 20 == 0 for _, d in drawn)


def test_odd_rows(spark):
    rows = [(None, "a " * 30), (1, "b " * 30), (1, "b " * 30), (1, "c " * 30), (2, None), (3, ""), (4, "w" * 600_000 + " x"), (5, "a b " * 200_000)]
    got = resampling.resample(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, None)], TARGET), percent=100).collect()
    assert len(got) == len(rows)
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == [1, 2, 3, 4, 5]
    assert {r["doc_id"]: r["n_features"] for r in got if r["doc_id"] in (2, 3, 4, 5)} == {2: 0, 3: 0, 4: 3, 5: 3 * 400_000 - 3}
    assert resampling.resample(spark.createDataFrame([], DOCS), spark.createDataFrame([], TARGET)).count() == 0


def test_bounds():
    assert resampling.bucket_gains(np.zeros(4, int), np.zeros(4, int)).tolist() == [0, 0, 0, 0]
    with pytest.raises(ValueError):
        resampling.hashed_runs(None, buckets=1 << 17)
