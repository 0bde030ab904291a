"""Comparison report of two models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally import fixed_values as V
from veritally.operators.compare import align_models, report_rows
from veritally.sources.problems import load_split, split_head
from veritally.workspace import materialize

LISTED_IDS = 1_000


def compare_models(
    problems: DataFrame,
    baseline: DataFrame,
    trained: DataFrame,
    split: str = "test",
    n: int | None = V.REPORT_ROWS,
) -> DataFrame:
    """The report on the first ``n`` questions of a split, or on all of them with None.

    With ``n`` the questions are picked and stored first and completions of other questions
    are dropped before any text work: up to ``LISTED_IDS`` by a list that the scan can prune by, more by a join.
    """
    if n is None:
        return report_rows(align_models(load_split(problems, split), baseline, trained))
    head = materialize(split_head(problems, split, n), "head")
    wanted = head.select("problem_id")
    if n <= LISTED_IDS:
        ids = [r[0] for r in wanted.collect()]  # at most LISTED_IDS numbers
        picked = [c.where(F.col("problem_id").isin(ids)) for c in (baseline, trained)]
    else:
        picked = [c.join(wanted, "problem_id", "left_semi") for c in (baseline, trained)]
    return report_rows(align_models(head, *picked))
