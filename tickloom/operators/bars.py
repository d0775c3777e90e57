"""The bar grid and the bar aggregate."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..plans.durable import durable
from ..plans.joins import checked_join
from ..schema import BARS, SERIES

FOLD_FROM = 4.0  # ticks per narrow bucket that make folding first worth its shuffle
MAX_PIECES = 512  # narrow buckets merged into one wide one at most


def tick_spans(ticks: DataFrame) -> DataFrame:
    """First and last tick time and number of ticks of each instrument."""
    return ticks.groupBy("ticker_id").agg(
        F.min("db_tsunx").alias("t_first"),
        F.max("db_tsunx").alias("t_last"),
        F.count(F.lit(1)).alias("ticks_cnt"),
    )


def gridded(ticks: DataFrame, grids: DataFrame, **join_limits) -> DataFrame:
    """Ticks with the number ``g`` (from 1) of the finished grid bucket they fall in.

    ``grids`` has one row per series: ``t_first``, where its grid starts, and ``t_last``, the
    last tick seen. Bucket g covers [t_first + (g-1)w, t_first + g*w) and is finished once its
    right side is not after ``t_last``. The bucket is arithmetic, so no range join is needed.
    """
    width_ms = F.col("bar_width_sec").cast("long") * 1000
    placed = checked_join(
        ticks, grids, ["ticker_id"], spread=["db_tsunx", "ts"], **join_limits
    ).where(F.col("db_tsunx").between(F.col("t_first"), F.col("t_last")))
    bucket = F.floor((F.col("db_tsunx") - F.col("t_first")) / width_ms) + 1
    return placed.withColumn("g", bucket).where(
        F.col("t_first") + F.col("g") * width_ms <= F.col("t_last")
    )


def mid() -> F.Column:
    return (F.col("ask") + F.col("bid")) / F.lit(2)


def finish_bars(raw: DataFrame) -> DataFrame:
    """Raw bucket aggregates to the stored bar columns.

    Expects the series, ``first_ms, last_ms, last_day``, unrounded ``o_, h_, l_, c_``,
    ``ticks_cnt`` and the population deviation ``sd``.
    """
    rounded = raw.select(
        *SERIES,
        F.col("last_day").alias("ddate"),
        F.col("first_ms").alias("ts_begin"),
        F.when(
            F.col("ticks_cnt") == 1,
            F.col("first_ms") + F.col("bar_width_sec").cast("long") * 1000,
        )
        .otherwise(F.col("last_ms"))
        .alias("ts_end"),
        *(half_up(F.col(f"{n}_"), 5).alias(n) for n in "ohlc"),
        F.col("ticks_cnt").cast("int").alias("ticks_cnt"),
        half_up(F.col("sd"), 6).alias("disp"),
    )
    o, c = F.col("o"), F.col("c")
    return rounded.withColumns(
        {
            "h_body": half_up(F.abs(c - o), 5),
            "h_shad": half_up(F.abs(F.col("h") - F.col("l")), 5),
            "btype": F.when(o < c, "g").when(o == c, "n").otherwise("r"),
            "log_co": half_up(F.log(c) - F.log(o), 5),
        }
    ).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in BARS))


def fold(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Ticks to one mergeable piece per key: first and last by (ddate, ts, db_tsunx), extremes,
    count, mean and sum of squared deviations. Partially aggregated, so a busy instrument is folded
    on the map side."""
    at = F.struct("ddate", "ts", "db_tsunx").alias("at")
    return (
        placed.select(*keys, at, mid().alias("mid"))
        .groupBy(*keys)
        .agg(
            F.min(F.struct("at", "mid")).alias("first"),
            F.max(F.struct("at", "mid")).alias("last"),
            F.max("mid").alias("h_"),
            F.min("mid").alias("l_"),
            F.count(F.lit(1)).alias("ticks_cnt"),
            F.avg("mid").alias("mean"),
            (F.var_pop("mid") * F.count(F.lit(1))).alias("m2"),
        )
    )


def merge(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces of the same key to one. A key has few pieces: their deviations are summed around the
    common mean, since a difference of moments loses its digits on large prices."""
    total = F.aggregate(
        "parts", F.lit(0.0), lambda acc, p: acc + p["mean"] * p["ticks_cnt"]
    ) / F.col("ticks_cnt")
    spread = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda acc, p: acc
        + p["m2"]
        + p["ticks_cnt"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")),
    )
    return (
        pieces.groupBy(*keys)
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.max("h_").alias("h_"),
            F.min("l_").alias("l_"),
            F.sum("ticks_cnt").alias("ticks_cnt"),
            F.collect_list(F.struct("ticks_cnt", "mean", "m2")).alias("parts"),
        )
        .withColumn("mean", total)
        .withColumn("m2", spread)
        .drop("parts")
    )


def bars_of_pieces(pieces: DataFrame) -> DataFrame:
    """One finished piece per bucket to bars."""
    return finish_bars(
        pieces.withColumns(
            {
                "o_": F.col("first.mid"),
                "c_": F.col("last.mid"),
                "first_ms": F.col("first.at.db_tsunx"),
                "last_ms": F.col("last.at.db_tsunx"),
                "last_day": F.col("last.at.ddate"),
                "sd": F.sqrt(F.col("m2") / F.col("ticks_cnt")),
            }
        )
    )


def bars_on_grid(ticks: DataFrame, grids: DataFrame, **join_limits) -> DataFrame:
    """One bar per finished, non-empty grid bucket, for all series of ``grids`` at once."""
    return bars_of_pieces(fold(gridded(ticks, grids, **join_limits), [*SERIES, "g"]))


def bars_from_first_tick(
    ticks: DataFrame, work_items: DataFrame, fold_from: float = FOLD_FROM, **join_limits
) -> DataFrame:
    """Bars of every (ticker_id, bar_width_sec) work item on a grid fixed at the instrument's
    first tick.

    All widths of an instrument share that start. With several widths and at least ``fold_from``
    ticks per bucket of their common divisor, ticks are folded once into such buckets and the bars
    of each width are merged from these pieces.
    """
    spans = durable(work_items.join(tick_spans(ticks), "ticker_id"), "grids")
    per_width = (  # one row per bar width
        spans.groupBy("bar_width_sec")
        .agg(
            F.sum("ticks_cnt").alias("ticks"), F.sum(F.col("t_last") - F.col("t_first")).alias("ms")
        )
        .collect()
    )
    grids = spans.drop("ticks_cnt")
    widths = [r["bar_width_sec"] for r in per_width]
    base = math.gcd(*widths)
    dense = all(r["ticks"] * base * 1000 >= fold_from * r["ms"] for r in per_width)
    if len(widths) < 2 or max(widths) // base > MAX_PIECES or not dense:
        return bars_on_grid(ticks, grids, **join_limits)
    narrow = grids.select(
        "ticker_id", F.lit(base).alias("bar_width_sec"), "t_first", "t_last"
    ).distinct()
    # A piece that is unfinished lies in an unfinished bucket of every width.
    pieces = fold(gridded(ticks, narrow, **join_limits), ["ticker_id", "g"])
    width_ms = F.col("bar_width_sec").cast("long") * 1000
    placed = checked_join(
        pieces.withColumnRenamed("g", "piece"), grids, ["ticker_id"], spread=["piece"], **join_limits
    ).withColumn("g", F.floor((F.col("piece") - 1) * base / F.col("bar_width_sec")) + 1)
    finished = F.col("t_first") + F.col("g") * width_ms <= F.col("t_last")
    return bars_of_pieces(merge(placed.where(finished), [*SERIES, "g"]))


def bars_dates_summary(bars: DataFrame) -> DataFrame:
    """Per series and day: number of bars, first and last bar end."""
    return bars.groupBy(*SERIES, "ddate").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min("ts_end").alias("ts_end_min"),
        F.max("ts_end").alias("ts_end_max"),
    )
