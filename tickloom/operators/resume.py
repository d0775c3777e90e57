"""Incremental bar building: read windows, one resume step, and the chain of steps."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.days import of_days
from ..plans.durable import durable
from ..plans.joins import checked_join
from ..schema import SERIES
from .bars import bars_on_grid
from .daysummary import day_summary, days_of_windows, edges, first_tick_from
from .meta import last_bars, resume_points

STEP_MS = 86_400_000
_SPREAD = ["db_tsunx", "ts"]


def _summary(ticks: DataFrame, summary: DataFrame | None) -> DataFrame:
    return durable(day_summary(ticks), "tick-days") if summary is None else summary


def read_windows(
    ticks: DataFrame, points: DataFrame, step_ms: int = STEP_MS, summary: DataFrame | None = None
) -> DataFrame:
    """Tick window [begin_from, read_to] of the next step of each series.

    Nominally one step long, not past the newest tick. It grows by whole steps until it spans a
    bar width of ticks or reaches the newest tick. How often it has to grow follows from the
    first tick that is a bar width after the first one read, so nothing is read repeatedly.
    ``summary`` is the day summary of the ticks (worked out here if not given); of the ticks
    themselves only the days that a mark falls into are read.
    """
    summary = _summary(ticks, summary)
    points = durable(points, "resume-points")
    started = first_tick_from(ticks, summary, points, "begin_from", "first_read")
    width_ms = F.col("bar_width_sec").cast("long") * 1000
    spanned = first_tick_from(
        ticks,
        summary,
        started.withColumn(
            "_enough", F.coalesce(F.col("first_read"), F.col("begin_from")) + width_ms
        ),
        "_enough",
        "_span_at",
    )
    newest = F.coalesce("last_tick_ts", "begin_from")
    planned = F.least(F.col("begin_from") + step_ms, newest)
    missing = F.greatest(F.coalesce("_span_at", newest) - planned, F.lit(0))
    return spanned.withColumn(
        "read_to", planned + F.ceil(missing / F.lit(step_ms)) * F.lit(step_ms)
    ).drop("_enough", "_span_at")


def resume_step(
    ticks: DataFrame, windows: DataFrame, summary: DataFrame | None = None, **limits
) -> DataFrame:
    """Finished bars of one read window per series; each grid starts at the first tick read. Only
    days are read on which an instrument has ticks in its own window."""
    windows = windows.where(F.col("first_read") <= F.col("read_to")).select(
        *SERIES, "first_read", "read_to"
    )
    in_days = of_days(
        ticks, days_of_windows(_summary(ticks, summary), windows, "first_read", "read_to")
    )
    grids = (
        checked_join(in_days, windows, ["ticker_id"], spread=_SPREAD, **limits)
        .where(F.col("db_tsunx").between(F.col("first_read"), F.col("read_to")))
        .groupBy(*SERIES)
        .agg(F.min("db_tsunx").alias("t_first"), F.max("db_tsunx").alias("t_last"))
    )
    return bars_on_grid(in_days, durable(grids, "grids"), **limits)


def bars_resumed(
    ticks: DataFrame,
    bars: DataFrame,
    items: DataFrame,
    step_ms: int = STEP_MS,
    summary: DataFrame | None = None,
    **limits,
) -> DataFrame:
    """The bars one incremental run adds, for all series at once. With the stored day ``summary``
    no tick is read outside the days of the read windows."""
    summary = _summary(ticks, summary)
    points = resume_points(items, last_bars(bars), edges(summary))
    windows = read_windows(ticks, points, step_ms, summary)
    return resume_step(ticks, windows, summary, **limits)


def bars_chained(
    ticks: DataFrame,
    items: DataFrame,
    step_ms: int = STEP_MS,
    summary: DataFrame | None = None,
    **limits,
) -> DataFrame:
    """Repeat resume steps until no series moves on.

    Every step restarts the grid at the last bar's end, so the bars depend on ``step_ms``. The
    driver only counts steps; each step is one distributed job over all series and reads just the
    days of its windows.
    """
    summary = _summary(ticks, summary)
    ends = durable(edges(summary), "tick-edges")
    newest = durable(
        items.select(*SERIES, F.lit(None).cast("long").alias("last_bar_ts_end")), "newest-bars"
    )
    limits = {"at_most": newest.count(), **limits}
    steps = []
    while True:
        points = resume_points(items, newest, ends)
        windows = read_windows(ticks, points, step_ms, summary)
        found = resume_step(ticks, windows, summary, **limits)
        # A grid that starts at a bar's end finds that bar's last ticks again. Several of them in
        # one millisecond can make a bar of their own, which must not replace the first one.
        fresh = durable(
            found.join(newest.withColumnRenamed("last_bar_ts_end", "_was"), SERIES)
            .where(F.col("_was").isNull() | (F.col("ts_end") > F.col("_was")))
            .select(*found.columns),
            "step",
        )
        steps.append(fresh)
        was, now = F.col("_was"), F.col("last_bar_ts_end")
        newest = durable(
            newest.withColumnRenamed("last_bar_ts_end", "_was")
            .join(last_bars(fresh), SERIES, "left")
            .select(
                *SERIES,
                F.greatest(was, now).alias("last_bar_ts_end"),
                F.coalesce((was.isNull() & now.isNotNull()) | (now > was), F.lit(False)).alias(
                    "moved"
                ),
            ),
            "newest-bars",
        )
        if newest.where("moved").isEmpty():
            return reduce(DataFrame.unionByName, steps)
        newest = newest.drop("moved")
