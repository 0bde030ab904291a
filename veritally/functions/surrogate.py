"""Clipped policy surrogate from logged log-probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritally import fixed_values as V


def importance_ratio(new_lp: Column, old_lp: Column) -> Column:
    return F.exp(new_lp - old_lp)


def clip_ratio(ratio: Column, eps: float = V.CLIP_EPS) -> Column:
    """The ratio kept within 1 - eps and 1 + eps. NaN stays NaN; Spark ranks it above all numbers."""
    return F.when(F.isnan(ratio), ratio).otherwise(F.least(F.greatest(ratio, F.lit(1.0 - eps)), F.lit(1.0 + eps)))


def clipped_surrogate(ratio: Column, advantage: Column, eps: float = V.CLIP_EPS) -> Column:
    """Per-token loss: the pessimistic one of the plain and the clipped product, negated; NaN if either is."""
    plain, clipped = ratio * advantage, clip_ratio(ratio, eps) * advantage
    return F.when(F.isnan(plain) | F.isnan(clipped), F.lit(float("nan"))).otherwise(-F.least(plain, clipped))
