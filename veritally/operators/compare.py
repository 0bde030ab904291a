"""Side-by-side comparison of two models on the same questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally import fixed_values as V
from veritally.functions.rewards import tolerance_match
from veritally.functions.text import (
    escape_markdown_cell,
    extract_gold,
    extract_prediction,
    number_text,
    pad_right,
    truncate_text,
    verdict_label,
)
from veritally.operators.numbering import with_position
from veritally.workspace import materialize


def _answers(completions: DataFrame, model: str, length: int) -> DataFrame:
    """What the report needs of a completion; the full text stops here."""
    return completions.select(
        "problem_id",
        truncate_text(F.col("completion"), length).alias(f"{model}_response"),
        extract_prediction(F.col("completion")).alias(f"{model}_pred"),
    )


def align_models(
    problems: DataFrame,
    baseline: DataFrame,
    trained: DataFrame,
    length: int = V.ELLIPSIS_LENGTH,
) -> DataFrame:
    """One row per question both models answered. Each table has one row per problem."""
    questions = problems.select(
        "problem_id",
        "split",
        "row_idx",
        truncate_text(F.col("question"), length).alias("question"),
        extract_gold(F.col("answer")).alias("gt"),
    )
    aligned = questions.join(_answers(baseline, "baseline", length), "problem_id").join(
        _answers(trained, "trained", length), "problem_id"
    )
    return aligned.withColumns(
        {
            f"{m}_ok": tolerance_match(F.col(f"{m}_pred"), F.col("gt"))
            for m in ("baseline", "trained")
        }
    )


def model_tally(aligned: DataFrame) -> DataFrame:
    """The 2x2 table of verdicts."""
    return aligned.groupBy("baseline_ok", "trained_ok").agg(F.count(F.lit(1)).alias("n"))


def model_totals(aligned: DataFrame) -> DataFrame:
    """Correct answers per model."""
    counts = aligned.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("baseline_ok")).alias("baseline"),
        F.count_if(F.col("trained_ok")).alias("trained"),
    )
    return counts.unpivot(["total"], ["baseline", "trained"], "model", "correct").select(
        "model", "correct", "total"
    )


def report_rows(aligned: DataFrame) -> DataFrame:
    """The seven report columns, numbered from 0 in stored order.

    Numbering reads its input several times, so the aligned rows, short by then, are stored first.
    """
    numbered = with_position(materialize(aligned, "aligned"), "row_idx", "idx")
    return numbered.select(
        "idx",
        "question",
        "gt",
        "baseline_response",
        verdict_label(F.col("baseline_ok")).alias("baseline_correct"),
        "trained_response",
        verdict_label(F.col("trained_ok")).alias("trained_correct"),
    )


def _cells(report: DataFrame) -> list[Column]:
    shown = [
        F.col("idx").cast("string"),
        F.col("question"),
        number_text(F.col("gt")),
        F.col("baseline_response"),
        F.col("baseline_correct"),
        F.col("trained_response"),
        F.col("trained_correct"),
    ]
    return [F.coalesce(c, F.lit("None")) for c in shown]


def _with_head(report: DataFrame, head: list[str], line: Column) -> DataFrame:
    """(line_no, line): the head lines numbered from 1, then one line per report row."""
    heading = report.sparkSession.range(1).select(
        F.posexplode(F.array(*(F.lit(h) for h in head))).alias("line_no", "line")
    )
    body = report.select((F.col("idx") + len(head) + 1).alias("line_no"), line.alias("line"))
    return heading.select((F.col("line_no") + 1).cast("long").alias("line_no"), "line").unionByName(body)


def fixed_width_lines(report: DataFrame) -> DataFrame:
    padded = [pad_right(c, w) for c, w in zip(_cells(report), V.REPORT_WIDTHS)]
    names = [n.ljust(w) for n, w in zip(V.REPORT_COLUMNS, V.REPORT_WIDTHS)]
    head = [V.REPORT_SEPARATOR.join(names), "-" * V.REPORT_RULE_WIDTH]
    return _with_head(report, head, F.concat_ws(V.REPORT_SEPARATOR, *padded))


def markdown_lines(report: DataFrame, escape: bool = True) -> DataFrame:
    """The Markdown report. Line breaks and pipes inside cells are escaped unless ``escape`` is off."""
    cells = [escape_markdown_cell(c) if escape else c for c in _cells(report)]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    header = "| " + " | ".join(V.REPORT_COLUMNS) + " |"
    return _with_head(report, [V.MARKDOWN_TITLE, "", header, V.MARKDOWN_RULE], row)
