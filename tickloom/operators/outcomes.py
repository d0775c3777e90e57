"""First later bar that reaches an up or a down target, for every bar and threshold.

A target is reached by a bar whose price range contains it; a bar that jumps past a target does
not count, so neither a running maximum nor a nearest-bar search answers the question. A self-join
would pair every bar with all later ones. Instead bars are numbered per series and put under a
tree of price hulls with ``FANOUT`` children per node. Each open search looks at one list of
siblings per round: it moves down into the first child whose hull can hold a target, or up when
there is none. A search usually costs a few lists of at most ``FANOUT`` entries, however far away
its answer is. Where hulls keep promising targets that no bar holds (thinly traded series, whose
bars are single prices), the searches still open after a fixed number of rounds go to an as-of match
on price cells instead.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..functions.times import whole_seconds
from ..plans.durable import durable
from ..plans.joins import HOT_ROWS, checked_join, split_hot
from ..plans.series import are_short, numbered
from ..schema import OUTCOMES, SERIES
from .pricecells import next_holding_bar

FANOUT = 64

_NODE = [*SERIES, "level", "parent"]
_SEARCH = [*SERIES, "seq", "log_oe", "up", "down"]
_ORDER = {
    "stored": ("ddate", ["ts_end", "ts_begin"]),
    "grid": ("ddate", ["ts_begin"]),
}


def reaches(up: Column, down: Column, low: Column, high: Column) -> Column:
    """Whether a price range holds either target. (One that spans both holds both.)"""
    return ((low <= up) & (up <= high)) | ((low <= down) & (down <= high))


def outcome_label(up: Column, down: Column, low: Column, high: Column) -> Column:
    """``mx`` up target reached, ``mn`` down target, ``bt`` both spanned, ``nn`` nothing found."""
    return (
        F.when(low.isNull(), "nn")
        .when((low <= up) & (up <= high), "mx")
        .when((low <= down) & (down <= high), "mn")
        .when((up <= high) & (down >= low), "bt")
        .otherwise("nn")
    )


def target_prices() -> dict[str, Column]:
    """The two target prices from columns ``c`` and ``log_oe``."""
    p = F.col("log_oe")
    return {
        "up": half_up(F.exp(F.log("c") + p), 4),
        "down": half_up(F.exp(F.log("c") - p), 4),
    }


def with_targets(bars: DataFrame, thresholds: list[float]) -> DataFrame:
    """Bars times thresholds, with the two target prices of each pair."""
    return bars.withColumn(
        "log_oe", F.explode(F.array(*(F.lit(float(t)) for t in thresholds)))
    ).withColumns(target_prices())


def numbered_bars(bars: DataFrame, order: str = "stored") -> DataFrame:
    """Bars numbered from 0 in their series, with their price range.

    ``stored`` order is (ddate, ts_end): a single-tick bar, whose end is inflated, can then come
    after its successor and give a negative duration. ``grid`` order is by ts_begin.
    A (series, day) slice holds at most one bar per bar width, so it is bounded by the clock.
    """
    day, within = _ORDER[order]
    slim = bars.select(
        *SERIES,
        "ddate",
        "ts_begin",
        "ts_end",
        "c",
        F.least("o", "h", "l", "c").alias("low"),
        F.greatest("o", "h", "l", "c").alias("high"),
    )
    if order == "grid":
        slim = slim.withColumn("_slice", F.floor(F.col("ts_begin") / 86_400_000))
        day = "_slice"
    order_by, whole = [F.col(c) for c in within], are_short(bars, SERIES)
    return numbered(slim, SERIES, day, order_by, whole=whole).drop("_slice")


def _sibling_lists(bars: DataFrame, fanout: int, longest: int) -> tuple[DataFrame, int]:
    """Rows (series, level, parent) with the price hulls of the children, at most ``fanout``, as
    two arrays in order. Returns the top level too."""
    level, nodes, lists = 0, bars.withColumnRenamed("seq", "idx"), []
    while True:
        rows = (
            nodes.withColumn("parent", F.floor(F.col("idx") / fanout))
            .groupBy(*SERIES, "parent")
            .agg(
                F.array_sort(F.collect_list(F.struct("idx", "low", "high"))).alias("kids"),
                F.min("low").alias("low"),
                F.max("high").alias("high"),
            )
        )
        lists.append(
            rows.select(
                *SERIES,
                F.lit(level).alias("level"),
                "parent",
                F.col("kids.low").alias("lows"),
                F.col("kids.high").alias("highs"),
            )
        )
        if fanout ** (level + 1) >= longest:
            return reduce(DataFrame.unionByName, lists), level
        nodes = rows.select(*SERIES, F.col("parent").alias("idx"), "low", "high")
        level += 1


def _advance(open_searches, lists, fanout, open_rows, hot_rows) -> DataFrame:
    """One round: look at the siblings from the cursor on and move down, up, or finish. ``open_rows`` is
    the most searches of one series.

    A finished search has level -1 and ``hit_seq``; one that went past the top found nothing.
    """
    searches = open_searches.withColumn("parent", F.floor(F.col("cursor") / fanout))
    on = _NODE
    if open_rows > hot_rows:  # otherwise no list can be wanted by more searches than that
        searches, lists = split_hot(
            searches, lists, _NODE, [*SERIES, "seq", "log_oe", "up", "down"], hot_rows
        )
        on = [*_NODE, "_part"]
    at = F.col("at")
    # Lists have no holes, so the cursor gives the place to start. Place ``fanout`` is past every
    # list and stands for "none". Exploding and taking the minimum stays in generated code; only
    # places that qualify reach the aggregate, which needs no shuffle after the join.
    start = (F.col("cursor") - F.col("parent") * fanout).cast("int")
    looked_at = (
        searches.join(lists, on, "left")
        .withColumn("at", F.explode(F.sequence(start, F.lit(fanout))))
        .where(
            (at == fanout)
            | reaches(F.col("up"), F.col("down"), F.get("lows", at), F.get("highs", at))
        )
        .groupBy(*searches.columns)
        .agg(F.min("at").alias("at"))
    )
    found, idx = at < fanout, F.col("parent") * fanout + at
    return looked_at.select(
        *_SEARCH,
        F.when(found, F.col("level") - 1).otherwise(F.col("level") + 1).alias("level"),
        F.when(found, idx * fanout).otherwise(F.col("parent") + 1).alias("cursor"),
        F.when(found & (F.col("level") == 0), idx).alias("hit_seq"),
    )


def first_hits(
    bars: DataFrame,
    thresholds: list[float],
    order: str = "stored",
    fanout: int = FANOUT,
    hot_rows: int = HOT_ROWS,
    max_rounds: int | None = None,
) -> DataFrame:
    """Every (bar, threshold) with its outcome: ``res_type`` and the hit bar, ``nn`` if none.

    ``max_rounds`` of the tree search (by default enough to climb to the top, down again and up
    once more) come before the price cells take over.
    """
    series = durable(numbered_bars(bars, order), "numbered-bars")
    return hits_of(series_tree(series, fanout), thresholds, hot_rows, max_rounds)


@dataclass(frozen=True)
class Tree:
    """Numbered bars, the sibling lists above them, the top level and the length of the longest series."""

    series: DataFrame
    lists: DataFrame
    top: int
    fanout: int
    longest: int
    bars: int


def series_tree(series: DataFrame, fanout: int = FANOUT) -> Tree:
    """The tree of price hulls over written, numbered bars."""
    counts = series.agg(F.max("seq").alias("m"), F.count(F.lit(1)).alias("n")).first()
    longest = (counts["m"] or 0) + 1
    lists, top = _sibling_lists(series, fanout, longest)
    if top > 0:
        lists = durable(lists, "sibling-lists")
    return Tree(series, lists, top, fanout, longest, counts["n"])


def hits_of(
    tree: Tree, thresholds: list[float], hot_rows: int = HOT_ROWS, max_rounds: int | None = None
) -> DataFrame:
    """``first_hits`` of bars that are numbered already."""
    if any(t < 0 for t in thresholds):
        raise ValueError("thresholds are sizes of a move and cannot be negative")
    most = tree.longest * len(thresholds)
    found = searched(
        with_targets(tree.series, thresholds).select(*_SEARCH), tree, most, hot_rows, max_rounds
    )
    return _with_hit_bars(with_targets(tree.series, thresholds), found, tree.series, hot_rows, most)


def searched(
    searches: DataFrame, tree: Tree, most: int, hot_rows: int = HOT_ROWS, max_rounds: int | None = None
) -> DataFrame:
    """Searches with the number ``hit_seq`` of the first bar after ``seq`` that holds a target; those
    without such a bar are left out. A series has at most ``most`` searches."""
    top = tree.top
    if max_rounds is None:
        max_rounds = 3 * top + 2
    searches = searches.select(
        *_SEARCH, F.lit(0).alias("level"), (F.col("seq") + 1).alias("cursor")
    )
    open_rows = tree.bars
    found = [searches.limit(0).select(*_SEARCH, F.col("seq").alias("hit_seq"))]
    for _ in range(max_rounds):
        if open_rows == 0:
            break
        state = durable(
            _advance(searches, tree.lists, tree.fanout, most, hot_rows), "search-round"
        )
        found.append(state.where(F.col("level") < 0).select(*_SEARCH, "hit_seq"))
        searches = state.where(F.col("level").between(0, top)).drop("hit_seq")
        open_rows = 0 if top == 0 else searches.count()
        most = min(most, open_rows)
    if open_rows:
        far = durable(next_holding_bar(searches, tree.series, hot_rows=hot_rows), "cell-hits")
        found.append(far.select(*_SEARCH, "hit_seq"))
    return reduce(DataFrame.unionByName, found)


def _with_hit_bars(pairs, found, series, hot_rows, most) -> DataFrame:
    """All (bar, threshold) pairs with the bar found for them, and the label."""
    hit = series.select(
        *SERIES,
        F.col("seq").alias("hit_seq"),
        F.col("ts_end").alias("ts_end_res"),
        F.col("ddate").alias("ddate_res"),
        F.col("c").alias("c_res"),
        F.col("low").alias("hit_low"),
        F.col("high").alias("hit_high"),
    )
    key = [*SERIES, "seq", "log_oe"]
    # One bar can end the search of very many earlier ones: its key is split like any hot key.
    answers = checked_join(
        found.drop("up", "down"),
        hit,
        [*SERIES, "hit_seq"],
        spread=key[2:],
        hot_rows=hot_rows,
        big_at_most=most,
    )
    return pairs.join(answers, key, "left").select(
        *SERIES,
        "ddate",
        "ts_begin",
        "ts_end",
        "c",
        "log_oe",
        "ts_end_res",
        "ddate_res",
        "c_res",
        outcome_label(F.col("up"), F.col("down"), F.col("hit_low"), F.col("hit_high")).alias(
            "res_type"
        ),
    )


def resolved(hits: DataFrame) -> DataFrame:
    """Outcomes as stored: only bars that reached a target, with the duration in seconds."""
    duration = whole_seconds(F.col("ts_end_res") - F.col("ts_end"))
    return (
        hits.where(F.col("ts_end_res").isNotNull())
        .withColumn("dursec_res", duration)
        .select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in OUTCOMES))
    )


def bars_unresolved(bars: DataFrame, outcomes: DataFrame, thresholds: list[float]) -> DataFrame:
    """Bars an incremental outcome run has to search: of each series those from the day of its oldest
    bar on that lacks an outcome at one of the thresholds. Series without such a bar are left out."""
    wanted = sorted({float(t) for t in thresholds})
    keys = [*SERIES, "ddate", "ts_end"]
    done = (
        outcomes.where(F.col("log_oe").isin(wanted))
        .groupBy(*keys)
        .agg(F.count_distinct("log_oe").alias("_n"))
        .where(F.col("_n") == len(wanted))
    )
    waiting = bars.select(*keys).join(done, keys, "left_anti")
    since = durable(waiting.groupBy(*SERIES).agg(F.min("ddate").alias("_since")), "unresolved-days")
    found = checked_join(bars, since, SERIES, "inner", spread=["ddate", "ts_end"])
    return found.where(F.col("ddate") >= F.col("_since")).drop("_since")


def bars_to_analyse(
    bars: DataFrame, outcomes: DataFrame | None = None, latest_only: bool = False
) -> DataFrame:
    """Bars an incremental outcome run reads: from each series' last analysed day (included) on.

    ``latest_only`` keeps just the newest bar day of each series.
    """
    found = bars
    if outcomes is not None:
        done = durable(
            outcomes.groupBy(*SERIES).agg(F.max("ddate").alias("_done")), "analysed-days"
        )
        found = (
            checked_join(found, done, SERIES, "left", spread=["ddate", "ts_end"])
            .where(F.col("_done").isNull() | (F.col("ddate") >= F.col("_done")))
            .drop("_done")
        )
    if latest_only:
        newest = bars.groupBy(*SERIES).agg(F.max("ddate").alias("ddate"))
        found = found.join(newest, [*SERIES, "ddate"], "left_semi")
    return found
