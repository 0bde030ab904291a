"""A corpus pipeline: documents to packed training rows in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads what it wrote. All stages but the
last return the columns of ``documents``, whatever further columns those have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from veritally.llm import decontaminate, jaccard, language, mixing, packing
from veritally.workspace import fresh_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels of ``docs`` teach. Those without a letter go, and those whose n-grams are far
    less likely in the best language than its own texts are. A close relative of a learned language can stay."""
    return language.keep_known(docs, language.learned_from(docs), min_score=0.5, min_fit=language.POOR_FIT)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that five-word shingles connect at 80 %, the one with the smallest doc_id stays; so do those without a word."""
    return jaccard.keep_representatives(docs, width=5, threshold=80)


def no_benchmark_passage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in training order; documents of small sources come up to three times."""
    return mixing.training_order(docs)


def token_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each_group),
    ("decontamination", no_benchmark_passage),
    ("source_mix", source_mix),
    ("token_packing", token_rows),
]

# The first stage's classifier and the last one's tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""

    def apply(docs: DataFrame, stage) -> DataFrame:
        name, function = stage
        path = fresh_path(spark, name)
        function(spark, docs, sf_dir).write.parquet(path)
        return spark.read.parquet(path)

    return reduce(apply, STAGES, spark.read.parquet(f"{sf_dir}/documents.parquet"))
