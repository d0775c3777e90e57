"""Rounding and ratios that give the same answer on every engine."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, places: int) -> Column:
    """Round half towards +infinity; NaN becomes 0.0, null stays null.

    ``F.round`` rounds negative halves away from zero, so it is not used here.
    """
    scale = float(10**places)
    known = F.nanvl(value, F.lit(0.0))
    return F.floor(known * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, null instead of an error when the bottom is zero."""
    return F.try_divide(top, bottom)


def rank_code(value: Column, *others: Column) -> Column:
    """1 above all the others, 3 below all the others, 2 in between or tied."""
    return (
        F.when(value > F.greatest(*others), 1).when(value < F.least(*others), 3).otherwise(2)
    )


def third_of(value: Column, low: Column, high: Column) -> Column:
    """Which third of [low, high] a price lies in: 1 top, 2 middle, 3 bottom."""
    step = (high - low) / F.lit(3.0)
    lower, upper = low + step, low + step + step
    return (
        F.when((value >= low) & (value <= lower), 3)
        .when((value >= lower) & (value < upper), 2)
        .otherwise(1)
    )
