"""The data path of a training epoch: scores and token log-probabilities to metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally import fixed_values as V
from veritally.functions.rewards import RewardFn, binary_reward
from veritally.functions.tokens import in_loss
from veritally.operators.batching import seeded_batches
from veritally.operators.metrics import batch_mean_reward, running_reward
from veritally.operators.policy import align_arrays, align_logprobs, broadcast_advantage, policy_loss, token_tasks
from veritally.operators.runs import can_pack, pack_runs, parts_by
from veritally.operators.skew import Hot, Keys, fits_broadcast, names, tasks_for
from veritally.plans.score import score_rollouts
from veritally.workspace import materialize

LISTED_PPO_EPOCHS = 64
SEQUENCES_PER_TASK = 500_000


def batched_scores(
    rollouts: DataFrame,
    problems: DataFrame,
    seed: int,
    epoch: int = 0,
    batch_size: int = V.TRAIN_BATCH_SIZE,
    reward_fn: RewardFn = binary_reward,
    gold_precision: str = "double",
    carry: Sequence[str] = (),
    hot: Hot | None = None,
) -> DataFrame:
    """Scored rollouts with their epoch and the batch their problem falls in.

    The batch number is joined to the problems, the smaller table, and then rides
    along with the gold number.
    """
    batches = seeded_batches(problems.select("problem_id"), "problem_id", batch_size, seed, epoch)
    scored = score_rollouts(
        rollouts,
        problems.join(batches, "problem_id"),
        reward_fn,
        gold_precision,
        carry=carry,
        problem_columns=["batch_id"],
        hot=hot,
        small=fits_broadcast(problems.select("problem_id")),
    )
    return scored.withColumn("epoch", F.lit(epoch))


def batched_scores_by_epoch(
    rollouts: DataFrame,
    problems: DataFrame,
    seed: int,
    epochs: Sequence[int],
    batch_size: int = V.TRAIN_BATCH_SIZE,
    reward_fn: RewardFn = binary_reward,
    gold_precision: str = "double",
    carry: Sequence[str] = (),
    hot: Hot | None = None,
) -> DataFrame:
    """The same for rollouts with an ``epoch`` column: a problem's samples of one epoch are a group, and each epoch has
    its own order of problems. Epochs not named are left out."""
    group = ["epoch", "problem_id"]
    wanted = rollouts.where(F.col("epoch").isin(list(epochs)))
    scored = score_rollouts(
        wanted, problems, reward_fn, gold_precision, carry=["epoch", *carry], hot=hot, group=group
    )
    ids = problems.select("problem_id")
    batches = (
        seeded_batches(ids, "problem_id", batch_size, seed, e).withColumn("epoch", F.lit(e)) for e in epochs
    )
    return scored.join(reduce(DataFrame.unionByName, batches), group)


def _stored_scores(scored: DataFrame, sequence: list[str]) -> DataFrame:
    """The narrow result of scoring, kept because rewards and advantages are used apart:
    the texts are read once."""
    columns = dict.fromkeys([*sequence, "epoch", "batch_id", "reward", "advantage"])
    return materialize(scored.select(*columns), "scores")


def _last_of_sequences(first_tokens: DataFrame, scored: DataFrame, sequence: list[str]) -> DataFrame:
    """(*sequence, ppo_epoch): the last one of each sequence. A sequence's PPO epochs become one row before the shuffle where they lie
    together; grouping in the tasks instead would hold as many sequences there as the table has."""
    found = first_tokens
    if can_pack(found, sequence) and parts_by(found, sequence) is None:
        packed = pack_runs(found, sequence).select(*sequence, F.array_max("ppo_epoch").alias("ppo_epoch"))
        found = packed.repartition(tasks_for(scored, SEQUENCES_PER_TASK), *sequence)
    return found.groupBy(*sequence).agg(F.max("ppo_epoch").alias("ppo_epoch"))


def _one_last_ppo_epoch(per_sequence: DataFrame) -> int | None:
    """The last PPO epoch if it is the same for every sequence, as it is where all of a run's epochs were scored."""
    least, most, unknown = per_sequence.agg(F.min("ppo_epoch"), F.max("ppo_epoch"), F.max(F.col("ppo_epoch").isNull())).first()
    return most if least == most and not unknown else None


def _last_ppo_epochs(first_tokens: DataFrame, scored: DataFrame, sequence: list[str]) -> tuple[DataFrame, Column]:
    """Sequences with the last PPO epoch of their batch, and a filter on ``ppo_epoch`` that holds for all of these.

    ``first_tokens`` has one row per sequence and PPO epoch that count in the loss; of a sequence only the last is moved on
    to its batch. The filter is a list of the few numbers
    that are the last of some batch, or their range; it is there before the token tables are shuffled.
    """
    last = (
        first_tokens.groupBy(*sequence).agg(F.max("ppo_epoch").alias("ppo_epoch")).hint("merge").join(scored.select(*dict.fromkeys([*sequence, "epoch", "batch_id"])), sequence)
        .groupBy("epoch", "batch_id")
        .agg(F.max("ppo_epoch").alias("_last"))
    )
    last = materialize(last, "last-ppo-epochs")
    listed = [r[0] for r in last.select("_last").distinct().limit(LISTED_PPO_EPOCHS + 1).collect()]
    wanted = F.col("ppo_epoch").isin(listed)
    if len(listed) > LISTED_PPO_EPOCHS:
        ends = last.agg(F.min("_last"), F.max("_last")).first()
        wanted = F.col("ppo_epoch").between(*ends)
    sequences = scored.select(*dict.fromkeys([*sequence, "epoch", "batch_id", "advantage"])).join(last, ["epoch", "batch_id"])
    return sequences, wanted


def _logged_metrics(scored: DataFrame, tokens: DataFrame, clip_eps: float, exact: bool = False) -> DataFrame:
    """Batch figures from scored rollouts and their weighted tokens. Every batch has a
    reward; a batch whose loss mask is empty keeps a NULL loss."""
    logged = policy_loss(tokens, ["epoch", "batch_id"], F.lit(1.0), clip_eps, exact)
    batches = batch_mean_reward(scored).join(logged, ["epoch", "batch_id"], "left")
    return running_reward(batches).select("epoch", "batch_id", "loss", "reward", "avg_reward")


def training_metrics(
    scored: DataFrame,
    old: DataFrame,
    new: DataFrame,
    prompt_length: Column,
    clip_eps: float = V.CLIP_EPS,
    hot_sequences: Hot | None = None,
    sequence: Keys = "seq_id",
    exact: bool = False,
) -> DataFrame:
    """(epoch, batch_id, loss, reward, avg_reward) for every batch; with ``exact`` losses have the same bits on any number of
    partitions.

    ``scored`` comes from ``batched_scores`` or ``batched_scores_by_epoch`` and carries the ``sequence`` columns; ``old`` is
    (*sequence, pos, lp) and ``new`` is (ppo_epoch, *sequence, pos, lp). Where sequence numbers come again in each
    epoch, ``sequence`` is ("epoch", "seq_id").

    The loss is that of the last PPO epoch of each batch. Which one that is shows in the first token of each
    sequence that counts; sequences meet their batch for it only if it is not the same for all. So the other PPO epochs never reach the joins; in a table stored in folders by
    ``ppo_epoch`` their files are not read. Prompt tokens are dropped before the joins as well.
    """
    keys = names(sequence)
    scored = _stored_scores(scored, keys)
    counts = in_loss(F.col("pos"), prompt_length) == 1
    starts = new.where(F.col("pos") == F.greatest(prompt_length - 1, F.lit(0))).select(*keys, "ppo_epoch")
    last = _one_last_ppo_epoch(_last_of_sequences(starts, scored, keys))
    if last is None:
        sequences, wanted = _last_ppo_epochs(starts, scored, keys)
    else:  # of every batch: no sequence has to meet its batch to know
        wanted = F.col("ppo_epoch") == last
        sequences = scored.select(*dict.fromkeys([*keys, "epoch", "batch_id", "advantage"]), F.lit(last).alias("_last"))
    counted = old.where(counts)
    weighted = broadcast_advantage(counted, sequences, hot_sequences, keys, token_tasks(counted, scored, keys))
    tokens = align_logprobs(weighted, new.where(counts & wanted), keys).where("ppo_epoch = _last")
    logged = partial(_logged_metrics, exact=True) if exact else _logged_metrics
    return logged(scored, tokens, clip_eps)


def training_metrics_from_arrays(
    scored: DataFrame,
    old: DataFrame,
    new: DataFrame,
    prompt_length: Column,
    clip_eps: float = V.CLIP_EPS,
    sequence: Keys = "seq_id",
    exact: bool = False,
) -> DataFrame:
    """The same figures from scores stored as one array per sequence: ``old`` is
    (*sequence, lps) and ``new`` is (ppo_epoch, *sequence, lps). No token is shuffled by itself, and none of the prompt or of
    an earlier PPO epoch at all."""
    keys = names(sequence)
    scored = _stored_scores(scored, keys)
    start = F.greatest(prompt_length - 1, F.lit(0))
    starts = new.where(F.size("lps") > start).select(*keys, "ppo_epoch")
    starts = materialize(starts.groupBy(*keys).agg(F.max("ppo_epoch").alias("ppo_epoch")), "last-of-sequences")
    last = _one_last_ppo_epoch(starts)
    if last is None:
        sequences, wanted = _last_ppo_epochs(starts, scored, keys)
    else:  # of every batch: no sequence has to meet its batch to know
        wanted = F.col("ppo_epoch") == last
        sequences = scored.select(*dict.fromkeys([*keys, "epoch", "batch_id", "advantage"]), F.lit(last).alias("_last"))
        sequences = sequences.repartition(tasks_for(sequences, SEQUENCES_PER_TASK), *keys)  # three tables meet in a task
    tokens = align_arrays(old, new.where(wanted), sequences, keys, start).where("ppo_epoch = _last")
    logged = partial(_logged_metrics, exact=True) if exact else _logged_metrics
    return logged(scored, tokens, clip_eps)
