"""Outcomes in several runs: searches that found nothing stay open, and meet only the newer bars.

The last bar of a series has nothing after it, so its searches are always open: the open searches also
say how far each (series, threshold) has been searched. A run searches the newer bars among themselves,
and asks for every open search of before which newer bar is the first to hold one of its targets. Both
go down the same tree of price hulls, with the newer bars as the only candidates; open searches with
equal targets ask once. Bars of earlier runs are not read, and a bar that never reaches
a target costs its one row.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from ..plans.joins import HOT_ROWS, SMALL_ROWS, checked_join
from ..plans.series import longest
from ..schema import OPEN_SEARCHES, OUTCOMES, SERIES
from .outcomes import (
    Tree,
    hits_of,
    numbered_bars,
    outcome_label,
    resolved,
    searched,
    series_tree,
    target_prices,
)

_PAIR = [*SERIES, "log_oe"]
_TARGETS = [*_PAIR, "up", "down"]


def searched_to(open_searches: DataFrame, thresholds: list[float]) -> DataFrame:
    """The last bar (``last``: day, end) that was searched, per (series, threshold)."""
    wanted = sorted({float(t) for t in thresholds})
    return (
        open_searches.where(F.col("log_oe").isin(wanted))
        .groupBy(*_PAIR)
        .agg(F.max(F.struct("ddate", "ts_end")).alias("last"))
    )


def series_searched_to(marks: DataFrame, thresholds: list[float]) -> DataFrame:
    """Per series the last bar that was searched at all of the thresholds; other series are new."""
    n = len({float(t) for t in thresholds})
    per_series = marks.groupBy(*SERIES).agg(F.min("last").alias("last"), F.count(F.lit(1)).alias("_n"))
    return per_series.where(F.col("_n") == n).drop("_n")


def days_to_read(dates: DataFrame, days: DataFrame, reached: DataFrame) -> DataFrame:
    """Days with bars that were not searched yet.

    ``dates`` is the stored day summary of the bars, ``days`` the days of the bar table and ``reached``
    the last searched bar per series. A day without any summary is read.
    """
    last = checked_join(dates, reached, SERIES, "left", spread=["ddate", "curr_ts"])
    newer = F.struct("ddate", F.col("ts_end_max").alias("ts_end")) > F.col("last")
    newer = last.where(F.col("last").isNull() | newer).select("ddate")
    return newer.union(days.join(dates, "ddate", "left_anti").select("ddate")).distinct()


def _after(rows: DataFrame, marks: DataFrame, on: list[str], **limits) -> DataFrame:
    spread = ["ddate", "ts_end"]
    found = checked_join(rows, marks, on, "left", spread=spread, **limits)
    newer = F.struct("ddate", "ts_end") > F.col("last")
    return found.where(F.col("last").isNull() | newer).drop("last")


def outcomes_resumed(
    bars: DataFrame,
    open_searches: DataFrame,
    thresholds: list[float],
    hot_rows: int = HOT_ROWS,
    small_rows: int = SMALL_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(outcomes found by this run, all searches that are open after it).

    ``bars`` needs to hold the bars that are newer than the searched ones; others are left out. Open
    searches of other thresholds stay as they are. Newer bars must come after the searched ones in
    stored order (day, end): a bar that was changed after it had been searched is not looked at again.
    """
    limits = {"hot_rows": hot_rows, "small_rows": small_rows}
    wanted = sorted({float(t) for t in thresholds})
    open_searches = open_searches.select(*OPEN_SEARCHES.names)
    marks = durable(searched_to(open_searches, wanted), "searched-to")
    reached = durable(series_searched_to(marks, wanted), "series-searched-to")
    newer = durable(_after(bars, reached, SERIES, **limits), "newer-bars")

    tree = series_tree(durable(numbered_bars(newer), "numbered-newer"))
    hits = hits_of(tree, wanted, hot_rows)
    hits = durable(_after(hits, marks, _PAIR, **limits, big_at_most=tree.longest), "newer-hits")
    old = open_searches.where(F.col("log_oe").isin(wanted))
    answered = durable(_answered(old, tree, marks, limits), "answered")

    found = resolved(hits).unionByName(resolved(answered))
    unresolved = hits.where(F.col("ts_end_res").isNull()).withColumns(target_prices())
    left = (
        unresolved.select(*OPEN_SEARCHES.names)
        .unionByName(answered.where(F.col("ts_end_res").isNull()).select(*OPEN_SEARCHES.names))
        .unionByName(open_searches.where(~F.col("log_oe").isin(wanted)))
    )
    return found.select(*OUTCOMES.names), left


def _answered(old: DataFrame, tree: Tree, marks: DataFrame, limits: dict) -> DataFrame:
    """Every open search with the first bar of the tree that holds one of its targets, if any."""
    series, most = tree.series, longest(old, SERIES)
    limits = {**limits, "big_at_most": most}
    # Where a threshold is ahead of others of its series, some newer bars were met before.
    at = series.select(*SERIES, F.struct("ddate", "ts_end").alias("last"), "seq")
    begin = marks.join(at, [*SERIES, "last"], "left").select(
        *_PAIR, F.coalesce("seq", F.lit(-1).cast("long")).alias("seq")
    )
    begin = durable(begin, "search-begin")
    active = durable(series.select(*SERIES).distinct(), "active-series")
    asked = checked_join(
        old.select(*_TARGETS).distinct(), active, SERIES, "left_semi", spread=["up", "down"], **limits
    )
    asked = checked_join(asked, begin, _PAIR, spread=["up", "down"], **limits)
    found = searched(durable(asked, "asked"), tree, most, limits["hot_rows"])
    hit = series.select(
        *SERIES, F.col("seq").alias("hit_seq"), F.col("ts_end").alias("ts_end_res"),
        F.col("ddate").alias("ddate_res"), F.col("c").alias("c_res"), "low", "high",
    )
    answers = checked_join(
        found.drop("seq"), hit, [*SERIES, "hit_seq"], spread=["log_oe", "up", "down"], **limits
    )
    answers = durable(
        answers.withColumn(
            "res_type", outcome_label(F.col("up"), F.col("down"), F.col("low"), F.col("high"))
        ).drop("hit_seq", "low", "high"),
        "answers",
    )
    return checked_join(old, answers, _TARGETS, "left", spread=["ddate", "ts_end"], **limits)
