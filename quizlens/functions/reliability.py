"""Cronbach's alpha as the reports define it, and the two kinds of variance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The terms which keep the divisions defined.
SMOOTHING = 0.001
LEGACY_SMOOTHING = 0.01
LEGACY_ONE = 1.01


def variance(col: Column | str, estimator: str = "sample") -> Column:
    """Sample variance (null for one row) or population variance."""
    if estimator == "sample":
        return F.var_samp(col)
    if estimator == "population":
        return F.var_pop(col)
    raise ValueError(f"estimator must be 'sample' or 'population', not {estimator!r}")


def alpha_smoothed(ssi2: Column, sx2: Column, k: Column) -> Column:
    """(1 - ssi2/(sx2+0.001)) / (1 - 1/(k+0.001)). With one question the divisor is about 0.001, so values are huge."""
    one = F.lit(1.0)
    return (one - ssi2 / (sx2 + F.lit(SMOOTHING))) / (one - one / (k.cast("double") + F.lit(SMOOTHING)))


def alpha_legacy(ssi2: Column, sx2: Column, k: Column) -> Column:
    """1 - ssi2/(sx2+0.01)/(1.01 - 1 div k): the divisor binds to the ratio, and 1 div k is a whole-number division."""
    whole = F.when(k == 1, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.lit(1.0) - ssi2 / (sx2 + F.lit(LEGACY_SMOOTHING)) / (F.lit(LEGACY_ONE) - whole)
