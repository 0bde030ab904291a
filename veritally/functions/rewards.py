"""Reward expressions. A reward function is any ``(pred, gold) -> Column``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritally import fixed_values as V

RewardFn = Callable[[Column, Column], Column]


def with_gold_precision(gold: Column, precision: str = "double") -> Column:
    """``'float'`` rounds the gold number through float32 before it is compared."""
    if precision == "double":
        return gold
    if precision == "float":
        return gold.cast("float").cast("double")
    raise ValueError(f"gold_precision must be 'double' or 'float', not {precision!r}")


def tolerance_match(pred: Column, gold: Column, tol: float = V.TOLERANCE) -> Column:
    """Strictly closer than ``tol``; false when either side is NULL."""
    return F.coalesce(F.abs(pred - gold) < F.lit(tol), F.lit(False))


def binary_reward(pred: Column, gold: Column, tol: float = V.TOLERANCE) -> Column:
    return F.when(tolerance_match(pred, gold, tol), F.lit(1.0)).otherwise(F.lit(0.0))
