"""Rounding, clipping and logistic, as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, low: float, high: float) -> Column:
    """Limit ``x`` to [low, high]. NaN stays NaN and NULL stays NULL, which
    ``least``/``greatest`` alone would turn into a bound."""
    return F.when(x.isNull() | F.isnan(x), x).otherwise(
        F.least(F.greatest(x, F.lit(low)), F.lit(high))
    )


def round_half_even(x: Column, digits: int = 0) -> Column:
    """Round ties to the even neighbour; ``digits`` may be negative.

    Scales, rounds to a whole number and scales back, as array libraries do.
    Unlike ``bround`` this needs no decimal per row, and agrees with them where
    scaling turns a decimal tie into a binary near-tie.
    """
    scale = F.lit(float(10 ** abs(digits)))
    if digits > 0:
        return F.rint(x * scale) / scale
    if digits < 0:
        return F.rint(x / scale) * scale
    return F.rint(x)


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def unsigned_zero(x: Column) -> Column:
    """Negative zero as zero; everything else as it is."""
    return F.when(x == F.lit(0.0), F.lit(0.0)).otherwise(x)
