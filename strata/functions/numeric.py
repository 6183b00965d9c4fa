"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are rounded to this many decimals before ranking and in results, so that
# sums added in a different order (another engine, another partitioning) tie and
# compare equal.
SCORE_DECIMALS = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: Column | str) -> Column:
    """String → double, null when the text is not a number or is NaN.

    ``try_cast`` rather than ``cast``: with ANSI mode on, ``cast`` raises on bad
    text.  NaN becomes null because NaN compares greater than any number in Spark,
    while the trip filters must treat it as failing every comparison.
    """
    value = _col(c).try_cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def round_score(c: Column | str, decimals: int = SCORE_DECIMALS) -> Column:
    return F.round(_col(c), decimals)


def logistic(theta: Column) -> Column:
    """σ(θ) = 1 / (1 + e^-θ); e^-θ overflowing to +inf gives 0, as it should."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-theta))
