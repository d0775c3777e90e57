"""One row per instrument and day of ticks: how many, the first and the last, and the range of times.

Kept up day by day next to the ticks (``sinks.tables.refresh_days``), it answers what a job must know
before it reads ticks: where an instrument begins and ends, and on which days a window of time has
ticks. Only days that a window cuts are then looked at tick by tick.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.days import of_days
from ..plans.durable import durable
from ..plans.joins import checked_join
from ..schema import SERIES


def day_summary(ticks: DataFrame) -> DataFrame:
    at = F.struct("ts", "db_tsunx")
    return ticks.groupBy("ticker_id", "ddate").agg(
        F.count(F.lit(1)).alias("ticks_count"),
        F.min_by("db_tsunx", at).alias("first_ts"),
        F.max_by("db_tsunx", at).alias("last_ts"),
        F.min("db_tsunx").alias("min_tsunx"),
        F.max("db_tsunx").alias("max_tsunx"),
    )


def edges(summary: DataFrame) -> DataFrame:
    """First and newest tick time of each instrument, by (ddate, ts, db_tsunx)."""
    return summary.groupBy("ticker_id").agg(
        F.min_by("first_ts", "ddate").alias("first_ts"),
        F.max_by("last_ts", "ddate").alias("last_tick_ts"),
    )


def total_counts(summary: DataFrame) -> DataFrame:
    return summary.groupBy("ticker_id").agg(F.sum("ticks_count").alias("ticks_count"))


def days_of_windows(summary: DataFrame, windows: DataFrame, begin: str, end: str) -> DataFrame:
    """Days on which the windows' own instruments have ticks between ``begin`` and ``end``."""
    met = checked_join(summary, windows.select("ticker_id", begin, end), ["ticker_id"], spread=["ddate"])
    met = met.where((F.col("max_tsunx") >= F.col(begin)) & (F.col("min_tsunx") <= F.col(end)))
    return met.select("ddate").distinct()


def first_tick_from(ticks: DataFrame, summary: DataFrame, windows: DataFrame, begin: str, out: str):
    """``windows`` (better a written table) with the first tick time at or after each ``begin``.

    A day that begins later answers by its summary. Ticks are read only of the days that ``begin``
    falls into, and joined on instrument and day.
    """
    marks = windows.select(*SERIES, begin)
    later = checked_join(summary, marks, ["ticker_id"], spread=["ddate"])
    later = later.where(F.col("max_tsunx") >= F.col(begin))
    inside = F.col("min_tsunx") < F.col(begin)
    cut = durable(later.where(inside).select(*SERIES, "ddate", begin), "cut-days")
    read = of_days(ticks.select("ticker_id", "ddate", "ts", "db_tsunx"), cut)
    cut_at = checked_join(read, cut, ["ticker_id", "ddate"], spread=["db_tsunx", "ts"])
    cut_at = cut_at.where(F.col("db_tsunx") >= F.col(begin)).groupBy(*SERIES).agg(F.min("db_tsunx").alias(out))
    whole = later.where(~inside).groupBy(*SERIES).agg(F.min("min_tsunx").alias(out))
    found = cut_at.unionByName(whole).groupBy(*SERIES).agg(F.min(out).alias(out))
    return durable(windows.join(found, SERIES, "left"), "windows")
