"""First later bar holding a target price, by an as-of match on price cells.

Targets lie on a fixed price grid, so a bar's range is a run of grid cells. The run is cut into its
few aligned power-of-two blocks and a target asks for the aligned blocks that contain it: a target
is in a bar exactly when they share one block. What is left is "the next bar number after mine" per
(series, block). The work per bar and per search is logarithmic in the widest bar, whatever the
distance to the answer.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.durable import durable
from ..plans.joins import checked_join
from ..schema import SERIES

SCALE = 10_000.0  # targets are rounded to 4 places
SLICE = 65_536  # bar numbers searched together
_BLOCK = [*SERIES, "level", "block"]
_SEARCH = [*SERIES, "seq", "log_oe", "up", "down"]


def _cells(series: DataFrame) -> DataFrame:
    """Bars with the first and last grid cell in their range; bars without any cell drop out."""
    scale = F.lit(SCALE)
    first, last = F.ceil(F.col("low") * scale), F.floor(F.col("high") * scale)
    # Scaling can be off by one unit in the last place: settle it by the comparison itself.
    first = (
        F.when((first - 1) / scale >= F.col("low"), first - 1)
        .when(first / scale < F.col("low"), first + 1)
        .otherwise(first)
    )
    last = (
        F.when((last + 1) / scale <= F.col("high"), last + 1)
        .when(last / scale > F.col("high"), last - 1)
        .otherwise(last)
    )
    return (
        series.select(*SERIES, "seq", first.alias("a"), last.alias("b"))
        .where(F.col("a") <= F.col("b"))
        .withColumn("levels", F.length(F.bin(F.col("b") - F.col("a") + 1)) - 1)
    )


def _bar_blocks(cells: DataFrame) -> DataFrame:
    """The aligned blocks that make up each bar's run of cells, at most two per level."""
    whole = cells.select(
        *SERIES, "seq", "a", "b", F.explode(F.sequence(F.lit(0), F.col("levels"))).alias("level")
    ).selectExpr(
        *SERIES,
        "seq",
        "level",
        "-shiftright(-a, level) AS left",
        "shiftright(b + 1, level) - 1 AS right",
        "-shiftright(-a, level + 1) AS up_left",
        "shiftright(b + 1, level + 1) - 1 AS up_right",
    )
    left, right = F.col("left"), F.col("right")
    topmost = F.col("up_left") > F.col("up_right")
    ends = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(topmost | (left < F.col("up_left") * 2), left),
                F.when(topmost | (right > F.col("up_right") * 2 + 1), right),
            )
        )
    )
    return whole.where(left <= right).select(
        *SERIES, "level", F.explode(ends).alias("block"), "seq"
    )


def _search_blocks(searches: DataFrame, top: int) -> DataFrame:
    """The block of every level up to ``top`` that contains one of a search's targets."""
    cell = F.explode(F.array(*(F.round(F.col(t) * F.lit(SCALE)).cast("long") for t in ("up", "down"))))
    return (
        searches.select(*_SEARCH, cell.alias("cell"))
        .withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top))))
        .selectExpr(*_SEARCH, "level", "shiftright(cell, level) AS block")
    )


def next_holding_bar(searches: DataFrame, series: DataFrame, **limits) -> DataFrame:
    """Searches that a later bar answers, with its number ``hit_seq``.

    ``searches`` carries ``up`` and ``down``; ``series`` the numbered bars with ``low``, ``high``.
    """
    # Only bars after the first open search of their series can answer one.
    opened = durable(searches.groupBy(*SERIES).agg(F.min("seq").alias("_from")), "open-series")
    candidates = checked_join(series, opened, SERIES, spread=["seq"], **limits).where(
        F.col("seq") > F.col("_from")
    )
    cells = _cells(candidates)
    top = cells.agg(F.max("levels")).first()[0]
    if top is None:
        return searches.limit(0).select(*_SEARCH, F.col("seq").alias("hit_seq"))
    wanted = durable(_search_blocks(searches, top), "search-blocks")
    blocks = checked_join(
        _bar_blocks(cells),
        wanted.select(*_BLOCK).distinct(),
        _BLOCK,
        "left_semi",
        spread=["seq"],
        **limits,
    )
    entries = (
        blocks
        .withColumns(
            {"bar": F.col("seq"), **{n: F.lit(None).cast("double") for n in _SEARCH[-3:]}}
        )
        .unionByName(wanted.withColumn("bar", F.lit(None).cast("long")))
        .withColumns({"slice": F.floor(F.col("seq") / SLICE), "back": -F.col("seq")})
    )
    # Backwards, so that "the next bar" is a growing window.
    later = (
        Window.partitionBy(*_BLOCK, "slice")
        .orderBy("back")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    later_slices = (
        Window.partitionBy(*_BLOCK)
        .orderBy(F.col("slice").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    beyond = (
        entries.groupBy(*_BLOCK, "slice")
        .agg(F.min("bar").alias("bar"))
        .withColumn("beyond", F.min("bar").over(later_slices))
        .drop("bar")
    )
    return (
        entries.join(beyond, [*_BLOCK, "slice"])
        .withColumn("next", F.coalesce(F.min("bar").over(later), F.col("beyond")))
        .where(F.col("log_oe").isNotNull() & F.col("next").isNotNull())
        .groupBy(*_SEARCH)
        .agg(F.min("next").alias("hit_seq"))
    )

