"""Runs of neighbouring outcomes, and the last bar of each run."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import whole_seconds
from ..plans.durable import durable
from ..plans.series import are_short, running_total, with_previous
from ..schema import SERIES

WAYS = ["mx", "mn"]
_RUN = [*SERIES, "log_oe", "res_type"]


def islands(outcomes: DataFrame, koeff: int = 2) -> DataFrame:
    """Outcomes with the number ``grp`` (from 1) of their run.

    Within one (series, threshold, way) a new run starts when the gap to the bar before is at
    least ``koeff`` bar widths; a gap of exactly the limit splits too.
    """
    usable = outcomes.where(F.col("res_type").isin(*WAYS))
    gap = whole_seconds(F.col("ts_end") - F.col("_before"))
    whole = are_short(usable, _RUN)
    starts = with_previous(
        usable, _RUN, "ddate", ["ts_end"], "ts_end", "_before", whole
    ).withColumn(
        "_new",
        (F.col("_before").isNull() | (gap >= F.col("bar_width_sec") * koeff)).cast("long"),
    )
    if not whole:
        starts = durable(starts, "run-starts")
    return running_total(starts, _RUN, "ddate", ["ts_end"], "_new", "grp", whole).drop(
        "_before", "_new"
    )


def island_ends(outcomes: DataFrame, koeff: int = 2) -> DataFrame:
    """The bar(s) with the largest ts_end of each run.

    First the largest within each day of the run, then over the run's days, so a run that covers a
    whole series is never gathered in one place.
    """
    within_day = Window.partitionBy(*_RUN, "ddate", "grp")
    over_days = Window.partitionBy(*_RUN, "grp")
    last = F.col("ts_end") == F.col("_max")
    return (
        islands(outcomes, koeff)
        .withColumn("_max", F.max("ts_end").over(within_day))
        .where(last)
        .withColumn("_max", F.max("ts_end").over(over_days))
        .where(last)
        .drop("_max")
    )
