"""Metadata aggregates and the joins that make the work list."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import whole_seconds
from ..schema import SERIES


def first_ticks(ticks: DataFrame) -> DataFrame:
    """First tick of each instrument: its first day, then (ts, db_tsunx) within it."""
    return ticks.groupBy("ticker_id").agg(
        F.min("ddate").alias("first_ddate"),
        F.min_by("db_tsunx", F.struct("ddate", "ts", "db_tsunx")).alias("first_ts"),
    )


def last_ticks(ticks: DataFrame) -> DataFrame:
    """Newest tick of each instrument: its last day, then (ts, db_tsunx) within it."""
    return ticks.groupBy("ticker_id").agg(
        F.max("ddate").alias("last_tick_ddate"),
        F.max_by("db_tsunx", F.struct("ddate", "ts", "db_tsunx")).alias("last_tick_ts"),
    )


def last_bars(bars: DataFrame) -> DataFrame:
    """Newest bar end of each series: its last day, then the largest ts_end of that day."""
    return bars.groupBy(*SERIES).agg(
        F.max("ddate").alias("last_bar_ddate"),
        F.max_by("ts_end", F.struct("ddate", "ts_end")).alias("last_bar_ts_end"),
    )


def day_range(table: DataFrame, by: list[str] = SERIES) -> DataFrame:
    """First and last day stored per series (or per any other key)."""
    return table.groupBy(*by).agg(
        F.min("ddate").alias("min_ddate"), F.max("ddate").alias("max_ddate")
    )


def distinct_days(table: DataFrame) -> DataFrame:
    return table.select(*SERIES, "ddate").distinct().orderBy(*SERIES, "ddate")


def key_counts(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("row_cnt"),
        F.countDistinct("ticker_id").alias("tickers"),
        F.countDistinct(*SERIES).alias("series"),
        F.countDistinct("ddate").alias("days"),
    )


def tickers_with_first_tick(tickers: DataFrame, ticks: DataFrame) -> DataFrame:
    """The whole dictionary; instruments without ticks keep empty first-tick columns."""
    return tickers.join(first_ticks(ticks), "ticker_id", "left")


def tickers_with_widths(tickers: DataFrame, bars_property: DataFrame) -> DataFrame:
    return tickers.join(bars_property, "ticker_id", "left_semi")


def work_items(tickers: DataFrame, bars_property: DataFrame) -> DataFrame:
    """Every enabled (ticker_id, bar_width_sec) of a known instrument."""
    return (
        tickers.select("ticker_id")
        .join(bars_property.where(F.col("is_enabled") == 1), "ticker_id")
        .select(*SERIES)
    )


def tick_edges(ticks: DataFrame) -> DataFrame:
    """First and newest tick time of each instrument, by (ddate, ts, db_tsunx)."""
    at = F.struct("ddate", "ts", "db_tsunx")
    return ticks.groupBy("ticker_id").agg(
        F.min_by("db_tsunx", at).alias("first_ts"), F.max_by("db_tsunx", at).alias("last_tick_ts")
    )


def resume_points(items: DataFrame, newest_bars: DataFrame, edges: DataFrame) -> DataFrame:
    """Where the bar build of each work item goes on: after its last bar, else at its first tick,
    else at its last tick, else at 0; and how many seconds behind the newest tick that is.

    ``newest_bars`` is ``last_bars(...)``, ``edges`` is ``tick_edges(...)``.
    """
    begin = F.coalesce("last_bar_ts_end", "first_ts", "last_tick_ts", F.lit(0))
    newest = F.coalesce("last_tick_ts", F.lit(0))
    return (
        items.join(newest_bars.select(*SERIES, "last_bar_ts_end"), SERIES, "left")
        .join(edges, "ticker_id", "left")
        .withColumn("begin_from", begin)
        .withColumn("lag_sec", whole_seconds(newest) - whole_seconds(F.col("begin_from")))
    )
