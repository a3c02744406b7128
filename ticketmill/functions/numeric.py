from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of doubles depend on the order of the tasks; sums of decimals do not.
EXACT = "decimal(18,6)"


def is_true(condition: Column) -> Column:
    """The condition as a flag that is never NULL."""
    return F.coalesce(condition, F.lit(False))


def positive(col: Column) -> Column:
    """The value if it is above zero, else NULL: averages skip it."""
    return F.when(col > 0, col)


def positive_or_zero(col: Column) -> Column:
    """The value if it is above zero, else 0: sums are never NULL."""
    return F.when(col > 0, col).otherwise(0)


def round_half_even(col: Column, places: int) -> Column:
    """Round the scaled binary value, ties to even.

    round() and bround() work on the printed decimal instead: 1.015 gives 1.02 there, 1.01 here.
    """
    scale = F.lit(10.0**places)
    return F.rint(col * scale) / scale


def null_if_nan(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))


def ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Rounded quotient, half up; NULL if the denominator is 0 or NULL."""
    return F.round(F.try_divide(numerator.cast("double"), denominator), places)


def weighted_mean(col: Column, weight: Column, places: int) -> Column:
    """Rounded mean of the non-NULL values, each counted `weight` times.

    Values are summed as EXACT: decimals beyond the sixth are rounded off first, and values of 13 or
    more digits before the point, NaN and infinity fail or become NULL by the session's ANSI mode.
    Cleaned weather has none of these.
    """
    total = F.sum(col.cast(EXACT) * weight)
    return ratio(total, F.sum(F.when(col.isNotNull(), weight)), places)
