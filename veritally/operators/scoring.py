"""Gold numbers, rewards and group-relative advantages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally import fixed_values as V
from veritally.functions.rewards import RewardFn, binary_reward, with_gold_precision
from veritally.functions.text import extract_gold, extract_prediction
from veritally.operators.skew import SALT, Hot, Keys, fits_broadcast, join_unique, names, with_group_stats


def fan_out_samples(problems: DataFrame, k: int = V.GROUP_SIZE) -> DataFrame:
    """``k`` rows per problem, numbered by ``sample_idx``."""
    if k < 1:
        raise ValueError(f"{k} samples per problem")
    return problems.withColumn("sample_idx", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))


def attach_gold(
    rollouts: DataFrame,
    problems: DataFrame,
    carry: Sequence[str] = (),
    problem_columns: Sequence[str] = (),
    hot: Hot | None = None,
    keep_salt: bool = False,
    small: bool | None = None,
    unicode: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Pair each completion's number with its problem's gold number; ``unicode`` as in ``extract_prediction``.

    ``carry`` and ``problem_columns`` name further columns to keep of either side; ``parts`` as in ``join_unique``.
    Next to a broadcast the completion is read after the join, so completions of
    other problems cost no search. Before a shuffle it is reduced to its number
    first, so no text is shuffled.
    """
    kept = ["problem_id", "sample_idx", *carry]
    prediction = extract_prediction(F.col("completion"), unicode).alias("pred")
    golds = problems.select(
        "problem_id", *problem_columns, extract_gold(F.col("answer"), unicode).alias("gt")
    )
    small = fits_broadcast(golds) if small is None else small
    texts = rollouts.select(*kept, "completion")
    if small:
        paired = join_unique(texts, golds, "problem_id", ["sample_idx"], small=True)
        return paired.select(*kept, prediction, *problem_columns, "gt")
    return join_unique(
        texts.select(*kept, prediction),
        golds,
        "problem_id",
        ["sample_idx"],
        hot=hot,
        keep_salt=keep_salt,
        small=False,
        parts=parts,
    )


def add_reward(
    paired: DataFrame, reward_fn: RewardFn = binary_reward, gold_precision: str = "double"
) -> DataFrame:
    gold = with_gold_precision(F.col("gt"), gold_precision)
    return paired.withColumn("reward", reward_fn(F.col("pred"), gold))


def null_golds(problems: DataFrame) -> DataFrame:
    """Problems whose solution carries no number: they can never be rewarded."""
    return problems.where(extract_gold(F.col("answer")).isNull())


def group_mean_reward(scored: DataFrame, group: Keys = "problem_id") -> DataFrame:
    return scored.groupBy(*names(group)).agg(F.avg("reward").alias("mean_reward"))


def group_size_violations(df: DataFrame, k: int = V.GROUP_SIZE, key: Keys = "problem_id") -> DataFrame:
    """Groups that do not have exactly ``k`` rows."""
    return df.groupBy(*names(key)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != k)


def group_advantage(
    scored: DataFrame,
    group_size: int | None = None,
    hot: Hot | None = None,
    group: Keys = "problem_id",
) -> DataFrame:
    """Reward minus the mean reward of its group; no scaling.

    ``group`` names the columns whose values make a group: the problem, or also the epoch where a
    problem is sampled again in each, or a stored ``group_id``. With ``group_size`` the query fails on the first group of another size.
    """
    stats = with_group_stats(
        scored,
        group,
        ["sample_idx"],
        sums={"_total": F.col("reward"), "_n": F.lit(1)},
        hot=hot,
    )
    advantage = F.col("reward") - F.col("_total") / F.col("_n")
    if group_size is not None:
        message = F.format_string(
            f"group %s has %d rows, not {group_size}", F.concat_ws(", ", *(F.col(g).cast("string") for g in names(group))), F.col("_n")
        )
        advantage = F.when(F.col("_n") == group_size, advantage).otherwise(F.raise_error(message))
    return stats.withColumn("advantage", advantage).drop("_total", "_n", SALT)
