"""Output tables: the metrics log and the text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally import fixed_values as V
from veritally.functions.text import fixed_decimals
from veritally.schemas import BATCH_METRICS, require_columns


def log_metrics(metrics: DataFrame, path: str) -> None:
    """Write batch metrics to the log, one folder per epoch. Epochs written again replace their folder, others stay."""
    (
        require_columns(metrics, BATCH_METRICS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch")
        .parquet(path)
    )


def write_report(lines: DataFrame, path: str, single_file: bool = False) -> None:
    """Write report lines as text in ``line_no`` order, in files whose names sort in that order.

    ``single_file`` forces one file, hence one task: only for reports over the first n questions.
    """
    ordered = lines.repartition(1).sortWithinPartitions("line_no") if single_file else lines.orderBy("line_no")
    ordered.select("line").write.mode("overwrite").text(path)


def metric_lines(batch_metrics: DataFrame) -> DataFrame:
    """The figures shown per batch, as text with four decimals."""
    shown = ("loss", "reward", "avg_reward")
    return batch_metrics.select("epoch", "batch_id", *(fixed_decimals(F.col(c)).alias(c) for c in shown))


def summary_lines(epochs: DataFrame) -> DataFrame:
    """(epoch, line_no, line): three lines per epoch, which is shown counting from 1."""
    before, after = V.EPOCH_HEADING
    lines = F.array(
        F.concat(F.lit(before), (F.col("epoch") + 1).cast("string"), F.lit(after)),
        F.concat(F.lit(V.LOSS_LABEL), fixed_decimals(F.col("avg_loss"))),
        F.concat(F.lit(V.REWARD_LABEL), fixed_decimals(F.col("avg_reward"))),
    )
    return epochs.select("epoch", F.posexplode(lines).alias("line_no", "line"))


def accuracy_line(accuracy: DataFrame, prefix: str = "") -> DataFrame:
    """The accuracy as one line of text, with a name in front if wanted."""
    label = F.lit(prefix + V.ACCURACY_LABEL)
    return accuracy.select(F.concat(label, fixed_decimals(F.col("accuracy"))).alias("line"))
