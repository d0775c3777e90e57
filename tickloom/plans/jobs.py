"""The jobs a user runs, over a folder of Parquet tables: load ticks, build bars, outcomes, forms."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators import bars as bar_ops
from ..operators import forms as form_ops
from ..operators import islands, marks, meta, opensearch, outcomes, resume
from ..session import prepare
from ..sinks import tables as sinks
from ..sources import tables
from .days import of_days
from .durable import durable

_SCHEMAS = {
    "ticks": schema.TICKS,
    "ticks_days": schema.TICKS_DAYS,
    "ticks_pending": schema.PENDING_DAYS,
    "tickers": schema.TICKERS,
    "bars_property": schema.BARS_PROPERTY,
    "bars": schema.BARS,
    "bars_bws_dates": schema.BARS_DATES,
    "bars_fa": schema.OUTCOMES,
    "bars_forms": schema.FORMS,
}


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        """A table the caller needs: it is an error where it has never been written."""
        return prepare(self.spark).read.schema(_SCHEMAS[name]).parquet(self.path(name))

    def read_own(self, name: str) -> DataFrame:
        """A table the caller writes itself: empty before its first run."""
        return sinks.read_or_empty(prepare(self.spark), self.path(name), _SCHEMAS[name])


_TICK_TABLES = ("ticks", "ticks_days", "ticks_pending")


def load_ticks(store: Store, ticks: DataFrame) -> None:
    """Copy ticks into the store and bring the stored day summary up to date for their days. It is
    worked out from what is stored, so loading the same ticks again changes nothing."""
    prepare(store.spark)
    sinks.load_ticks(ticks, *map(store.path, _TICK_TABLES))


def tick_days(store: Store) -> DataFrame:
    """The stored summary per instrument and day: counts, first and last tick, range of times."""
    return sinks.tick_days(prepare(store.spark), *map(store.path, _TICK_TABLES))


def build_bars(store: Store, mode: str = "first_tick", step_sec: int = 86_400) -> None:
    """Bars of every enabled (instrument, width).

    ``first_tick`` builds the whole history on one grid per instrument; ``resume`` adds one read
    window after the last stored bar; ``chained`` repeats that to the newest tick.
    """
    ticks = store.read("ticks")
    items = durable(
        meta.work_items(store.read("tickers"), store.read("bars_property")), "work-items"
    )
    if mode == "first_tick":
        built = bar_ops.bars_from_first_tick(ticks, items)
    elif mode == "resume":
        built = resume.bars_resumed(
            ticks, store.read_own("bars"), items, step_sec * 1000, tick_days(store)
        )
    elif mode == "chained":
        built = resume.bars_chained(ticks, items, step_sec * 1000, tick_days(store))
    else:
        raise ValueError(f"unknown mode: {mode}")
    built = durable(built, "bars")
    if not built.isEmpty():
        sinks.save_bars(built, store.path("bars"), store.path("bars_bws_dates"))


def build_outcomes(
    store: Store,
    thresholds: list[float],
    incremental: bool = True,
    latest_only: bool = False,
    from_last_day: bool = False,
) -> None:
    """Outcomes of the stored bars. An incremental run reads the days with bars that were not searched
    yet, searches those bars and answers the searches that earlier runs left open, so a target reached
    by newer bars is found for old bars too. A full run searches all bars again. ``from_last_day``
    starts at the last day with an outcome instead and leaves older bars as they are."""
    bars = store.read("bars")
    if from_last_day or latest_only:
        stored = store.read_own("bars_fa") if incremental else None
        todo = outcomes.bars_to_analyse(bars, stored, latest_only)
        found = outcomes.resolved(outcomes.first_hits(todo, thresholds))
        sinks.save_outcomes(found, store.path("bars_fa"))
        return
    waiting = open_searches(store)
    if incremental:
        bars = bars_not_searched(store, waiting, thresholds)
    else:
        waiting = waiting.where(~waiting.log_oe.isin(*[float(t) for t in thresholds]))
    found, left = opensearch.outcomes_resumed(bars, waiting, thresholds)
    # Outcomes first: if the run ends in between, the next one finds and saves the same ones again.
    sinks.save_outcomes(found, store.path("bars_fa"))
    sinks.save_open(left, *map(store.path, _OPEN_TABLES))


_OPEN_TABLES = ("bars_open", "bars_open_runs")


def open_searches(store: Store) -> DataFrame:
    """Searches that found no bar yet, with their targets."""
    return sinks.open_searches(prepare(store.spark), *map(store.path, _OPEN_TABLES))


def bars_not_searched(store: Store, waiting: DataFrame, thresholds: list[float]) -> DataFrame:
    """Stored bars of the days with bars that come after the searched ones, by the day summary. (Bars
    added past it to a day that it names are found when that day is saved with its summary.)"""
    bars = store.read("bars")
    marks = opensearch.searched_to(waiting, thresholds)
    reached = durable(opensearch.series_searched_to(marks, thresholds), "searched-series")
    dates = store.read_own("bars_bws_dates")
    days = durable(bars.select("ddate").distinct(), "bar-days")
    return of_days(bars, opensearch.days_to_read(dates, days, reached))


# What tells the end of one run of outcomes from another.
_END = [*schema.SERIES, "ts_end", "log_oe", "res_type"]


def build_forms(
    store: Store,
    thresholds: list[float],
    deep: int = 6,
    koeff: int = 2,
    lags: tuple[int, int, int] | None = None,
    incremental: bool = True,
    clip_to_first: bool = False,
    retract: bool = False,
) -> None:
    """Forms of the last bar of each run of outcomes.

    An incremental run goes on from the stored forms; the end of a run saved earlier stays even if a
    later bar extends that run. With ``retract`` the ends are worked out from all outcomes, which needs
    no ticks: forms are built for the ends that have none yet, and stored forms whose bar is no longer
    an end are taken back. With the same parameters the table is then that of one run over everything,
    however many runs led to it and whenever an outcome came in.
    """
    found = store.read("bars_fa")
    wanted = [float(t) for t in thresholds]
    found = found.where(found.log_oe.isin(*wanted))
    gone = None
    if incremental and not retract:
        series = found.select(*schema.SERIES).distinct()
        resume_at = marks.form_resume_marks(
            series, store.read_own("bars_forms"), thresholds, deep
        )
        found = tables.outcomes_since(found, resume_at)
    kept = durable(islands.island_ends(found, koeff), "island-ends")
    if retract:
        stored = store.read_own("bars_forms").where(F.col("log_oe").isin(*wanted))
        gone = stored.join(kept.select(*_END), _END, "left_anti")
        if incremental:
            current = stored.where(F.col("formdeepkoef") == deep).select(*_END)
            kept = durable(kept.join(current, _END, "left_anti"), "new-ends")
    built = form_ops.build_forms(store.read("ticks"), kept, deep, lags, clip_to_first)
    sinks.save_forms(
        form_ops.with_prop_map(form_ops.complete(built)), store.path("bars_forms"), gone
    )
