"""Score rollouts: completions and problems to rewards and advantages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from veritally.functions.rewards import RewardFn, binary_reward
from veritally.operators.scoring import add_reward, attach_gold, group_advantage
from veritally.operators.skew import NO_HOT, Hot, Keys, find_hot_keys, fits_broadcast, is_hot, names, tasks_for


def score_rollouts(
    rollouts: DataFrame,
    problems: DataFrame,
    reward_fn: RewardFn = binary_reward,
    gold_precision: str = "double",
    group_size: int | None = None,
    carry: Sequence[str] = (),
    problem_columns: Sequence[str] = (),
    hot: Hot | None = None,
    small: bool | None = None,
    group: Keys = "problem_id",
    unicode: bool = False,
) -> DataFrame:
    """(problem_id, sample_idx, *carry, pred, *problem_columns, gt, reward, advantage).

    The join and the group mean share one partitioning by problem, so a large
    problem table costs one exchange per side and a broadcast one costs one in all.
    ``small`` says whether the golds can be broadcast; None has their size checked.
    ``group`` names the columns that make a group, see ``group_advantage``; those that ``problems`` does not
    have must be among ``carry``. ``unicode`` reads digits and spaces of all scripts. With more than the problem, hot groups are looked for apart from hot problems,
    among the rollouts where these have the group's columns, and as many tasks share the rows as need to hold a bounded number each.
    """
    if names(group) != ["problem_id"]:
        small = fits_broadcast(problems.select("problem_id", *problem_columns)) if small is None else small
        hot_problems = NO_HOT if small else find_hot_keys(rollouts, "problem_id")
        parts = tasks_for(rollouts)
        if hot is None and set(names(group)) <= set(rollouts.columns):
            hot = find_hot_keys(rollouts, group)
        paired = attach_gold(rollouts, problems, carry, problem_columns, hot_problems, small=small, unicode=unicode, parts=parts)
        if small or is_hot(hot_problems):
            paired = paired.repartition(parts, *names(group))
        return group_advantage(add_reward(paired, reward_fn, gold_precision), group_size, hot, group)
    hot = find_hot_keys(rollouts, "problem_id") if hot is None else hot
    paired = attach_gold(
        rollouts, problems, carry, problem_columns, hot, keep_salt=True, small=small, unicode=unicode
    )
    scored = add_reward(paired, reward_fn, gold_precision)
    return group_advantage(scored, group_size, hot)
