import zlib

import numpy as np
from pyspark.sql import functions as F

from veritally.llm import language
from veritally.llm.queries import QUERIES


def test_held_out_documents(spark, sf_dir):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op1_language_id"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in docs if zlib.crc32(str(d).encode()) % 5 == 0}
    assert all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.97


def test_scores_are_bayes(spark):
    """Against plain counting of n-grams, letter by letter."""
    rows = [(1, "abc abd", "x"), (2, "xyz xyy", "y"), (3, "abba", "x"), (4, None, "x"), (5, "q", None)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("x", "y")

    def grams(text):
        t = " " + text
        out = [t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)]
        return [g for g in out if g != " " and "  " not in g]

    counts = {k: [g for _, t, lab in rows if t and lab == k for g in grams(t)] for k in "xy"}
    texts = ["abd", "xyab", "zz top"]
    names, scores = language.score_texts(texts, model)
    for text, name, score in zip(texts, names, scores):
        logs = {}
        for k, prior in (("x", 2 / 3), ("y", 1 / 3)):
            total = len(counts[k]) + language.SMOOTHING * language.BUCKETS
            logs[k] = np.log(prior) + sum(np.log((counts[k].count(g) + language.SMOOTHING) / total) for g in grams(text))
        best = max(logs, key=logs.get)
        assert name == best
        assert abs(score - 1 / sum(np.exp(v - logs[best]) for v in logs.values())) < 1e-4


def test_odd_texts(spark):
    rows = [(1, "der die das", "de"), (2, "the cat", "en"), (3, None, None), (4, "", "en"), (5, "12 %% \n", "de"), (5, "12 %% \n", "de"), (None, "the dog", None), (6, "x" * 300_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("mine"))
    got = language.document_languages(docs).collect()
    assert len(got) == len(rows)
    und = [(r["doc_id"], r["score"]) for r in got if r["lang_pred"] == "und"]
    assert sorted(und) == [(3, 0.0), (4, 0.0), (5, 0.0), (5, 0.0)]
    model = language.fit(docs)
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "6", "None"]
    empty = docs.where("false")
    assert language.document_languages(empty).count() == 0
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(empty)).collect()} == {"und"}


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.range(4000).select(F.concat(F.lit("word "), "id").alias("text"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("lang"))
    small = [language.fit(docs.repartition(n), docs_per_language=200) for n in (3, 7)]
    assert (small[0].log_prob == small[1].log_prob).all()
    assert language.fit(docs).log_prior.tolist() == small[0].log_prior.tolist()
