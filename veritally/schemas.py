"""Record schemas and a check that a DataFrame carries them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PROBLEMS = T.StructType(
    [
        T.StructField("problem_id", T.LongType()),
        T.StructField("row_idx", T.LongType()),
        T.StructField("split", T.StringType()),
        T.StructField("question", T.StringType()),
        T.StructField("answer", T.StringType()),
    ]
)

ROLLOUTS = T.StructType(
    [
        T.StructField("problem_id", T.LongType()),
        T.StructField("sample_idx", T.IntegerType()),
        T.StructField("completion", T.StringType()),
    ]
)

BATCH_METRICS = T.StructType(
    [
        T.StructField("epoch", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("reward", T.DoubleType()),
        T.StructField("avg_reward", T.DoubleType()),
    ]
)


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` cut to the columns of ``schema``; an error names what is missing or mistyped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [
        f"{f.name}: want {f.dataType.simpleString()}, have "
        f"{have[f.name].simpleString() if f.name in have else 'nothing'}"
        for f in schema.fields
        if have.get(f.name) != f.dataType
    ]
    if problems:
        raise ValueError("unexpected schema; " + "; ".join(problems))
    return df.select(*schema.fieldNames())
