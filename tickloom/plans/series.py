"""Order-dependent columns over a whole series without putting the series in one task.

A series (one ``keys`` value) is cut into slices that follow its order, e.g. calendar days.
Rows are windowed inside their slice; one summary row per slice carries positions and totals
across. The summary window holds a series' slices, never its rows.

Where no series has more than ``WHOLE_ROWS`` rows (``are_short``), slices would only repeat the rows:
with ``whole`` each series is windowed as it is, in one shuffle.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


WHOLE_ROWS = 500_000


def longest(df: DataFrame, keys: list[str]) -> int:
    """Rows of the longest series."""
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return rows.agg(F.max("_n")).first()[0] or 0


def are_short(df: DataFrame, keys: list[str], rows: int = WHOLE_ROWS) -> bool:
    """No series has more than ``rows`` rows."""
    return longest(df, keys) <= rows


def _whole(df, keys, slice_col, order, out, value) -> DataFrame:
    """``value`` of a series' window as column ``out``. Rows without a series or slice get no place, but
    those without a slice come before the others, as in the summary of slices."""
    for c in keys:
        df = df.where(F.col(c).isNotNull())
    along = Window.partitionBy(*keys).orderBy(slice_col, *order)
    return df.withColumn(out, value(along)).where(F.col(slice_col).isNotNull())


def _before(keys, slice_col):
    return (
        Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    )


def numbered(
    df: DataFrame,
    keys: list[str],
    slice_col: str,
    order: list[Column],
    out: str = "seq",
    whole: bool = False,
) -> DataFrame:
    """0-based position of each row in its series."""
    if whole:
        return _whole(
            df, keys, slice_col, order, out, lambda w: F.row_number().over(w).cast("long") - 1
        )
    starts = (
        df.groupBy(*keys, slice_col)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(_before(keys, slice_col)), F.lit(0)))
        .drop("_n")
    )
    within = Window.partitionBy(*keys, slice_col).orderBy(*order)
    return (
        df.join(starts, [*keys, slice_col])
        .withColumn(out, F.col("_start") + F.row_number().over(within) - 1)
        .drop("_start")
    )


def with_previous(
    df: DataFrame,
    keys: list[str],
    slice_col: str,
    order: list[str],
    value: str,
    out: str,
    whole: bool = False,
) -> DataFrame:
    """Value of the row before, across slice borders; null on the first row of a series."""
    if whole:
        return _whole(df, keys, slice_col, order, out, F.lag(value).over)
    last = (
        df.groupBy(*keys, slice_col)
        .agg(F.max_by(value, F.struct(*order)).alias("_last"))
        .withColumn(
            "_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy(slice_col))
        )
        .drop("_last")
    )
    within = Window.partitionBy(*keys, slice_col).orderBy(*order)
    return (
        df.join(last, [*keys, slice_col])
        .withColumn(out, F.coalesce(F.lag(value).over(within), F.col("_carry")))
        .drop("_carry")
    )


def running_total(
    df: DataFrame,
    keys: list[str],
    slice_col: str,
    order: list[str],
    value: str,
    out: str,
    whole: bool = False,
) -> DataFrame:
    """Sum of ``value`` over the rows up to and including this one."""
    if whole:
        so_far = (Window.unboundedPreceding, Window.currentRow)
        return _whole(
            df, keys, slice_col, order, out, lambda w: F.sum(value).over(w.rowsBetween(*so_far))
        )
    carried = (
        df.groupBy(*keys, slice_col)
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_carry", F.coalesce(F.sum("_sum").over(_before(keys, slice_col)), F.lit(0)))
        .drop("_sum")
    )
    within = (
        Window.partitionBy(*keys, slice_col)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.join(carried, [*keys, slice_col])
        .withColumn(out, F.col("_carry") + F.sum(value).over(within))
        .drop("_carry")
    )
