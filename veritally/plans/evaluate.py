"""Accuracy of a model's completions on a split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.functions.rewards import RewardFn, binary_reward
from veritally.operators.metrics import accuracy
from veritally.operators.scoring import add_reward, attach_gold
from veritally.operators.skew import Hot
from veritally.sources.problems import load_split


def evaluate_split(
    completions: DataFrame,
    problems: DataFrame,
    split: str = "test",
    by: Sequence[str] = (),
    reward_fn: RewardFn = binary_reward,
    gold_precision: str = "double",
    hot: Hot | None = None,
    unicode: bool = False,
    skip_null_golds: bool = False,
) -> DataFrame:
    """Correct, total and accuracy, per ``by`` columns of the completions if given.

    A problem whose solution has no number counts as answered wrongly; with ``skip_null_golds`` it does not count.
    ``null_golds`` lists such problems.
    """
    carry = [c for c in by if c != "sample_idx"]
    paired = attach_gold(completions, load_split(problems, split), carry, hot=hot, unicode=unicode)
    if skip_null_golds:
        paired = paired.where(F.col("gt").isNotNull())
    return accuracy(add_reward(paired, reward_fn, gold_precision), by)
