"""Score rollouts as files arrive and keep the batch metrics up to date.

Each micro-batch writes its own folder of the output and overwrites it when it is
run again, so a restart after a failure leaves no row twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from veritally.functions.rewards import RewardFn, binary_reward
from veritally.operators.scoring import add_reward, attach_gold, group_advantage
from veritally.operators.skew import NO_HOT, Hot, Keys, names
from veritally.plans.score import score_rollouts

FILES_PER_TRIGGER = 64


def read_rollout_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_trigger: int = FILES_PER_TRIGGER,
    name_pattern: str = "*.parquet",
) -> DataFrame:
    """Parquet files of a table's folder as a stream, a bounded number of files per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", name_pattern)
        .parquet(path)
    )


def batch_metrics_stream(
    rollouts: DataFrame,
    problems: DataFrame,
    reward_fn: RewardFn = binary_reward,
    gold_precision: str = "double",
    hot: Hot = NO_HOT,
) -> DataFrame:
    """Running (batch_id, n, reward) over everything that has arrived.

    A problem table too large to broadcast is shuffled; ``hot`` then names the problems to spread, such as
    ``find_hot_keys`` finds in rollouts stored before. Batch means are combined before the shuffle.

    State is one row per batch. There is no event time, hence no watermark, and the
    state grows with the number of batches.
    """
    paired = attach_gold(rollouts, problems, ["batch_id"], hot=hot)
    return (
        add_reward(paired, reward_fn, gold_precision)
        .groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("reward").alias("reward"))
    )


def _write_micro_batch(path: str):
    def write(df: DataFrame, micro_batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/micro_batch={micro_batch}")

    return write


def start_batch_metrics(metrics: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the batches each micro-batch changed, until the input is used up."""
    return (
        metrics.writeStream.outputMode("update")
        .foreachBatch(_write_micro_batch(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


METRICS_SCHEMA = "batch_id long, n long, reward double, micro_batch int"


def latest_batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every batch written so far; empty if none was."""
    newest = F.max_by(F.struct("n", "reward"), "micro_batch")
    return (
        _written(spark, path, METRICS_SCHEMA)
        .groupBy("batch_id")
        .agg(newest.alias("m"))
        .select("batch_id", "m.n", "m.reward")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _written(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """What the micro-batches wrote to a folder that may not be there yet."""
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same with the columns that were stored; ``schema`` is that of an empty result."""
    return spark.read.parquet(path).drop("micro_batch") if _exists(spark, path) else spark.createDataFrame([], schema)


def start_scores(
    rollouts: DataFrame,
    problems: DataFrame,
    path: str,
    checkpoint: str,
    carry: Sequence[str] = (),
    reward_fn: RewardFn = binary_reward,
    gold_precision: str = "double",
) -> StreamingQuery:
    """Store scored rollouts, without advantages, as they arrive: for groups that may be split over files."""

    def write(df: DataFrame, micro_batch: int) -> None:
        scored = add_reward(attach_gold(df, problems, carry), reward_fn, gold_precision)
        _write_micro_batch(path)(scored, micro_batch)

    return (
        rollouts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_advantages(
    spark: SparkSession,
    path: str,
    group: Keys = "problem_id",
    group_size: int | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """The batch pass over what ``start_scores`` has stored, carried columns included: advantages over whole groups,
    wherever their rows arrived."""
    keys = ", ".join(f"{k} long" for k in names(group))
    stored = _stored(spark, path, f"{keys}, sample_idx int, pred double, gt double, reward double")
    return group_advantage(stored, group_size, hot, group)


def group_state(
    rollouts: DataFrame,
    problems: DataFrame,
    group: Keys = "problem_id",
    carry: Sequence[str] = (),
    reward_fn: RewardFn = binary_reward,
    gold_precision: str = "double",
    hot: Hot = NO_HOT,
) -> DataFrame:
    """(*group, n, total, members) of every group that a micro-batch touched, over all that has arrived of it.

    State is one row per group with the numbers of its samples; completions stay behind. A group that gets no more than its k
    samples has a state of that size. There is no event time, hence no watermark: state grows with the number of groups.
    """
    keys = names(group)
    scored = add_reward(attach_gold(rollouts, problems, [k for k in [*keys, *carry] if k != "problem_id"], hot=hot), reward_fn, gold_precision)
    member = F.struct(*(c for c in scored.columns if c not in keys))
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("reward").alias("total"), F.collect_list(member).alias("members")
    )


def complete_groups(state: DataFrame, group_size: int, group: Keys = "problem_id") -> DataFrame:
    """Scored rows with advantages of the groups that have just got their last sample.

    The samples of a group are counted up to ``group_size`` in one micro-batch only, so its rows leave the stream
    once. One sample more, which would change what has left, ends the query with an error.
    """
    keys = names(group)
    message = F.format_string(
        f"group %s has %d rows, not {group_size}", F.concat_ws(", ", *(F.col(k).cast("string") for k in keys)), F.col("n")
    )
    members = F.when(F.col("n") == group_size, F.col("members")).otherwise(F.raise_error(message))
    mean = F.try_divide(F.col("total"), F.col("n"))
    rows = state.where(F.col("n") >= group_size).select(*keys, mean.alias("_mean"), F.explode(members).alias("_member"))
    rows = rows.select(*keys, "_member.*", "_mean")
    return rows.withColumn("advantage", F.col("reward") - F.col("_mean")).drop("_mean")


def start_group_advantages(
    rollouts: DataFrame,
    problems: DataFrame,
    path: str,
    checkpoint: str,
    group_size: int,
    group: Keys = "problem_id",
    carry: Sequence[str] = (),
    reward_fn: RewardFn = binary_reward,
    gold_precision: str = "double",
    hot: Hot = NO_HOT,
) -> StreamingQuery:
    """Score rollouts as they arrive and write each group with its advantages when its last sample is there, in
    whatever files and micro-batches the samples come.

    Unfinished groups wait in the state of the stream, built-in aggregates of it, and go on waiting after a restart with the same
    ``checkpoint``. A micro-batch that is repeated overwrites its folder, so no group is written twice.
    """

    def write(df: DataFrame, micro_batch: int) -> None:
        _write_micro_batch(path)(complete_groups(df, group_size, group), micro_batch)

    return (
        group_state(rollouts, problems, group, carry, reward_fn, gold_precision, hot)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def group_advantages(spark: SparkSession, path: str, group: Keys = "problem_id") -> DataFrame:
    """What ``start_group_advantages`` has written so far."""
    keys = ", ".join(f"{k} long" for k in names(group))
    return _stored(spark, path, f"{keys}, sample_idx int, pred double, gt double, reward double, advantage double")


def unfinished_groups(spark: SparkSession, checkpoint: str, group_size: int) -> DataFrame:
    """(*group, n) of the groups that wait in the state of a stopped stream for further samples."""
    state = spark.read.format("statestore").load(checkpoint)
    n = F.col("value").getField(state.schema["value"].dataType.names[0])  # counted first in ``group_state``
    return state.select("key.*", n.alias("n")).where(F.col("n") < group_size)


def start_advantages(
    rollouts: DataFrame,
    problems: DataFrame,
    path: str,
    checkpoint: str,
    group_size: int,
    reward_fn: RewardFn = binary_reward,
    gold_precision: str = "double",
) -> StreamingQuery:
    """Score each micro-batch with advantages, for sources that deliver whole groups per file.

    A group that is not complete within a micro-batch ends the stream with an error instead of being centred on a
    partial mean; ``start_scores`` and ``late_advantages`` are for such sources.
    """

    def write(df: DataFrame, micro_batch: int) -> None:
        scored = score_rollouts(df, problems, reward_fn, gold_precision, group_size)
        _write_micro_batch(path)(scored, micro_batch)

    return (
        rollouts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
