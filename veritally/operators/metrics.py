"""Accuracy, batch and epoch figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.operators.numbering import running_sums
from veritally.workspace import materialize


def accuracy(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Correct, total and their ratio; the ratio is NULL when there are no rows."""
    return (
        scored.groupBy(*by)
        .agg(
            F.coalesce(F.sum("reward"), F.lit(0.0)).alias("correct"),
            F.count(F.lit(1)).alias("total"),
        )
        .withColumn("accuracy", F.try_divide("correct", "total"))
    )


def batch_mean_reward(scored: DataFrame, by: Sequence[str] = ("epoch", "batch_id")) -> DataFrame:
    return scored.groupBy(*by).agg(F.avg("reward").alias("reward"))


def epoch_mean_of_means(batch_metrics: DataFrame, values: Sequence[str] = ("loss", "reward")) -> DataFrame:
    """Mean of the batch figures: every batch counts alike, a short last one too."""
    return batch_metrics.groupBy("epoch").agg(
        F.count(F.lit(1)).alias("num_batches"), *(F.avg(v).alias(f"avg_{v}") for v in values)
    )


def running_reward(batch_metrics: DataFrame) -> DataFrame:
    """Mean reward over the batches of an epoch so far, as ``avg_reward``.

    An epoch can have any number of batches, so the sums run block by block
    instead of in one window per epoch. They read the batch table several times: it
    is stored first, so that what led to it runs once.
    """
    counted = materialize(batch_metrics, "batch-metrics").withColumn("_one", F.lit(1))
    sums = running_sums(counted, "batch_id", ["reward", "_one"], ["epoch"])
    so_far = (F.col("reward_before") + F.col("reward")) / (F.col("_one_before") + 1)
    return sums.withColumn("avg_reward", so_far).drop("_one", "reward_before", "_one_before")
