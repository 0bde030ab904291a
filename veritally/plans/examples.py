"""Prompts to padded, masked and batched training examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally import fixed_values as V
from veritally.functions.text import build_prompt, extract_gold
from veritally.functions.tokens import attention_mask, pad_left
from veritally.operators.batching import assign_batches
from veritally.operators.sequences import build_vocabulary, encode_rows, words
from veritally.workspace import materialize

PAD_ID = 0


def prompt_vocabulary(problems: DataFrame) -> DataFrame:
    """Vocabulary of all prompts, kept in the shared folder: it is read more than once."""
    prompts = words(problems, "problem_id", build_prompt(F.col("question")))
    return materialize(build_vocabulary(prompts))


def example_records(
    problems: DataFrame, vocabulary: DataFrame, max_length: int = V.MAX_LENGTH, carry: Sequence[str] = ()
) -> DataFrame:
    """(problem_id, *carry, prompt, input_ids, attention_mask, gt): the prompt with its ids and mask at ``max_length``, and
    the gold number. One word is one token, so what is cut off is dropped before it is encoded."""
    records = problems.select(
        "problem_id", *carry, build_prompt(F.col("question")).alias("prompt"), extract_gold(F.col("answer")).alias("gt")
    )
    encoded = encode_rows(records, "problem_id", F.col("prompt"), vocabulary, [*carry, "prompt", "gt"], max_length)
    return encoded.select(
        "problem_id",
        *carry,
        "prompt",
        pad_left(F.col("ids"), PAD_ID, max_length).alias("input_ids"),
        attention_mask(F.col("ids"), max_length).alias("attention_mask"),
        "gt",
    )


def prepare_examples(
    problems: DataFrame,
    vocabulary: DataFrame | None = None,
    max_length: int = V.MAX_LENGTH,
    batch_size: int = V.TRAIN_BATCH_SIZE,
) -> DataFrame:
    """(problem_id, batch_id, prompt, input_ids, attention_mask, gt), batched in stored order."""
    vocabulary = prompt_vocabulary(problems) if vocabulary is None else vocabulary
    batched = assign_batches(problems, batch_size)
    return example_records(batched, vocabulary, max_length, carry=["batch_id"])
