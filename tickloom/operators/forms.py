"""Features over the ticks in the ``deep * width`` seconds up to each kept bar.

Everything that needs tick order (the move from the tick before, the ask k ticks back) is worked
out once per tick along its instrument. Form features are then plain sums and counts: a lagged
pair belongs to a form exactly when its older tick lies in the form's window. No form's ticks are
ever sorted or gathered on their own, and overlapping forms share the tick work.

Two passes over the (tick, window) matches: extremes and moments first, then the counts that need
those extremes (histogram buckets, step sizes, time thirds).
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, rank_code, ratio, third_of
from ..functions.times import utc_day
from ..plans.days import of_days
from ..plans.durable import durable
from ..plans.joins import checked_join
from ..plans.series import are_short, numbered
from ..schema import FORM_PROPS, FORMS, SERIES

ROLES = ("acf_05_bws", "acf_1_bws", "acf_2_bws")
PEAK_BUCKETS = 10
BLOCK = 65_536  # ticks numbered together when looking back
SLICE_MS = 3_600_000
SLICE_ROWS = 4_000_000

_WINDOW = [*SERIES, "ts_end"]

# Rank codes of the three time thirds that make up each volume profile.
VOLUME_PROFILES = {
    (1, 2, 3): 1,
    (3, 2, 1): 2,
    (2, 1, 3): 3,
    (3, 1, 2): 3,
    (1, 3, 2): 4,
    (2, 3, 1): 4,
}


def default_lags(width: int) -> tuple[int, int, int]:
    """Autocorrelation lags, in ticks: half the bar width, the width, twice the width."""
    return width // 2, width, 2 * width


def form_windows(kept: DataFrame, deep: int, clip_to_first: bool = False) -> DataFrame:
    """Distinct tick windows of the kept bars: [ts_end - deep * width, ts_end], both included.

    ``clip_to_first`` starts no window before the instrument's first kept bar end.
    """
    windows = kept.select(*_WINDOW).distinct()
    begin = F.col("ts_end") - F.col("bar_width_sec").cast("long") * 1000 * deep
    if not clip_to_first:
        return windows.withColumn("from_ms", begin)
    first = durable(
        kept.groupBy("ticker_id").agg(F.min("ts_end").alias("_first")), "first-kept"
    )
    return (
        checked_join(windows, first, ["ticker_id"], spread=["ts_end", "bar_width_sec"])
        .withColumn("from_ms", F.greatest(begin, F.col("_first")))
        .drop("_first")
    )


def _in_buckets(windows: DataFrame, bucket_ms: int) -> DataFrame:
    """One row per time bucket a window touches."""
    first, last = (F.floor(F.col(c) / bucket_ms) for c in ("from_ms", "ts_end"))
    return windows.withColumn("bucket", F.explode(F.sequence(first, last)))


def _days_of_buckets(buckets: DataFrame, bucket_ms: int) -> DataFrame:
    """Every day that a bucket reaches into."""
    begin = F.col("bucket") * bucket_ms
    days = F.sequence(utc_day(begin), utc_day(begin + (bucket_ms - 1)))
    return buckets.select("bucket").distinct().select(F.explode(days).alias("ddate")).distinct()


def match_windows(ticks: DataFrame, windows: DataFrame, bucket_ms: int, **limits) -> DataFrame:
    """(tick, window) pairs with the tick inside the window: an equi-join on (instrument, time
    bucket), then the exact interval test. ``ticks`` carries ``bucket``.

    The bucket length suits the narrowest bar width. Wide windows cover several buckets, but there
    are correspondingly fewer of them, and every tick is sent once for all widths."""
    return checked_join(
        ticks,
        _in_buckets(windows, bucket_ms),
        ["ticker_id", "bucket"],
        spread=["db_tsunx", "ts"],
        **limits,
    ).where(F.col("db_tsunx").between(F.col("from_ms"), F.col("ts_end")))


def form_ticks(ticks: DataFrame, kept: DataFrame, deep: int, **limits) -> DataFrame:
    """The ticks of every form, one row per (form window, tick)."""
    windows = durable(form_windows(kept, deep), "form-windows")
    bucket_ms = 1000 * deep * (windows.agg(F.min("bar_width_sec")).first()[0] or 1)
    days = _days_of_buckets(_in_buckets(windows, bucket_ms), bucket_ms)
    bucketed = of_days(ticks, days).withColumn("bucket", F.floor(F.col("db_tsunx") / bucket_ms))
    return match_windows(bucketed, windows, bucket_ms, **limits).select(
        *_WINDOW, "ts", "db_tsunx", "ask", "bid"
    )


def _slice_ms(ticks: DataFrame, slice_rows: int) -> int:
    """Length of the time slices ticks are numbered in: an hour, or as much shorter as it takes
    to keep every instrument's slice within ``slice_rows`` ticks."""
    length = SLICE_MS
    while True:
        most = (
            ticks.groupBy("ticker_id", F.floor(F.col("db_tsunx") / length))
            .count()
            .agg(F.max("count"))
            .first()[0]
        )
        if length == 1 or (most or 0) <= slice_rows:
            return length
        length = max(1, length // -(-most // slice_rows))


def with_lags(
    ticks: DataFrame,
    lags: list[int],
    block: int = BLOCK,
    slice_rows: int = SLICE_ROWS,
    whole: bool = False,
) -> DataFrame:
    """Ticks with, for each lag k, the ask and time of the tick k positions before it in its
    instrument (``ask_k``, ``ms_k``), null before the start.

    Ticks are numbered in slices, cut into blocks of equal size by number, and each block gets the
    last ticks of the block before it. Blocks are bounded whatever the instrument's share. ``whole``
    says that no instrument has more ticks than a block: then each is looked along as it is.
    """
    if whole:
        # Ticks of one millisecond come newest first, as they are stored.
        order = [F.col("db_tsunx"), F.col("ts").desc()]
        along = Window.partitionBy("ticker_id").orderBy(*order)
        timed = ticks.where(F.col("db_tsunx").isNotNull())
        return numbered(timed, ["ticker_id"], "db_tsunx", order[1:], whole=True).select(
            "*",
            *(F.lag("ask", k).over(along).alias(f"ask_{k}") for k in lags),
            *(F.lag("db_tsunx", k).over(along).alias(f"ms_{k}") for k in lags),
        )
    reach = max(lags)
    block = max(block, reach)
    numbers = numbered(
        ticks.withColumn("_slice", F.floor(F.col("db_tsunx") / _slice_ms(ticks, slice_rows))),
        ["ticker_id"],
        "_slice",
        # Ticks of one millisecond come newest first, as they are stored.
        [F.col("db_tsunx"), F.col("ts").desc()],
    ).drop("_slice")
    own = F.floor(F.col("seq") / block)
    lent = F.col("seq") % block >= block - reach
    copies = numbers.withColumn("_own", own).withColumn(
        "_block",
        F.explode(F.when(lent, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))),
    )
    along = Window.partitionBy("ticker_id", "_block").orderBy("seq")
    looked_back = copies.select(
        "*",
        *(F.lag("ask", k).over(along).alias(f"ask_{k}") for k in lags),
        *(F.lag("db_tsunx", k).over(along).alias(f"ms_{k}") for k in lags),
    )
    return looked_back.where(F.col("_block") == F.col("_own")).drop("_own", "_block")


def _by_width(lags_of: dict[int, tuple[int, int, int]], role: int, column: str):
    """The lagged column a row's own width uses for one autocorrelation role."""
    return F.coalesce(
        *(
            F.when(F.col("bar_width_sec") == w, F.col(f"{column}_{lags[role]}"))
            for w, lags in lags_of.items()
        )
    )


def _first_pass():
    ask, move = F.col("ask"), F.col("ask") - F.col("ask_1")
    has_move = F.col("ms_1") >= F.col("from_ms")
    # Of several ticks in the last millisecond the first one counts as the last price.
    opens_ms = F.col("ms_1").isNull() | (F.col("ms_1") < F.col("db_tsunx"))
    up, down = F.when(has_move & (move > 0), move), F.when(has_move & (move < 0), -move)
    out = [
        F.count(F.lit(1)).alias("n"),
        F.min("db_tsunx").alias("t_min"),
        F.max("db_tsunx").alias("t_max"),
        F.min(ask).alias("low"),
        F.max(ask).alias("high"),
        F.min_by("ask", "seq").alias("first_ask"),
        F.max_by("ask", F.when(opens_ms, F.col("seq"))).alias("last_ask"),
        F.min(up).alias("up_min"),
        F.max(up).alias("up_max"),
        F.min(down).alias("down_min"),
        F.max(down).alias("down_max"),
    ]
    return out


def _step_width(side: str):
    spread = F.coalesce(F.col(f"{side}_max") - F.col(f"{side}_min"), F.lit(0.0))
    return half_up(spread / F.lit(10), 6)


def _lag_sums(lags_of):
    """Sums for the autocorrelations of prices above the form's lowest, so that small moves of a
    large price keep their digits; the extremes tell a flat side exactly."""
    out = []
    for i, role in enumerate(ROLES):
        paired = _by_width(lags_of, i, "ms") >= F.col("from_ms")
        x = F.when(paired, F.col("ask") - F.col("low"))
        y = F.when(paired, _by_width(lags_of, i, "ask") - F.col("low"))
        flat = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
        out += [
            flat.alias(f"{role}_flat"),
            F.count(x).alias(f"{role}_n"),
            F.sum(x).alias(f"{role}_x"),
            F.sum(y).alias(f"{role}_y"),
            F.sum(x * y).alias(f"{role}_xy"),
            F.sum(x * x).alias(f"{role}_xx"),
            F.sum(y * y).alias(f"{role}_yy"),
        ]
    return out


def _second_pass(lags_of):
    ask, ms = F.col("ask"), F.col("db_tsunx")
    step = (F.col("high") - F.col("low")) / F.lit(PEAK_BUCKETS)
    edge = [F.col("low") + step * F.lit(i) for i in range(PEAK_BUCKETS + 1)]
    third = F.floor((F.col("t_max") - F.col("t_min")) / 3)
    t1, t2 = F.col("t_min") + third, F.col("t_min") + third * 2
    move = F.col("ask") - F.col("ask_1")
    has_move = F.col("ms_1") >= F.col("from_ms")

    def counted(test, name):
        return F.count(F.when(test, 1)).alias(name)

    def steps(side, size):
        limit = F.col(f"{side}_min") + F.lit(11) * _step_width(side)
        return counted(has_move & (size > 0) & (size < limit), f"{side}_steps")

    return [
        *(
            counted((ask >= edge[i]) & (ask <= edge[i + 1]), f"peak_{i}")
            for i in range(PEAK_BUCKETS)
        ),
        steps("up", move),
        steps("down", -move),
        counted(ms <= t1, "third_1"),
        counted((ms >= t1) & (ms <= t2), "third_2"),
        counted(ms >= t2, "third_3"),
        *_lag_sums(lags_of),
    ]


def _autocorrelation(role: str):
    mean = {k: ratio(F.col(f"{role}_{k}"), F.col(f"{role}_n")) for k in ("x", "y", "xy", "xx", "yy")}
    var_x = F.greatest(mean["xx"] - mean["x"] * mean["x"], F.lit(0.0))
    var_y = F.greatest(mean["yy"] - mean["y"] * mean["y"], F.lit(0.0))
    r = ratio(mean["xy"] - mean["x"] * mean["y"], F.sqrt(var_x * var_y))
    return F.when(F.col(f"{role}_flat"), F.lit(0.0)).otherwise(F.coalesce(half_up(r, 3), F.lit(0.0)))


def _price_peak():
    """Lower edge of the first fullest of ten equal price buckets; the price itself if flat."""
    counts = F.array(*(F.col(f"peak_{i}") for i in range(PEAK_BUCKETS)))
    fullest = F.array_position(counts, F.array_max(counts)) - 1
    step = (F.col("high") - F.col("low")) / F.lit(PEAK_BUCKETS)
    return F.when(step == 0, F.col("low")).otherwise(F.col("low") + step * fullest)


def _finish(stats: DataFrame, deep: int) -> DataFrame:
    low, high = F.col("low"), F.col("high")
    moved = F.col("_up") + F.col("_down")
    long_enough = F.col("t_max") - F.col("t_min") >= F.lit(1000 * (deep - 1)) * F.col(
        "bar_width_sec"
    )
    peak_code = (
        third_of(F.col("first_ask"), low, high) * 100
        + third_of(F.col("peak_price"), low, high) * 10
        + third_of(F.col("last_ask"), low, high)
    )
    parts = {f"_v{i}": half_up(ratio(F.col(f"third_{i}"), F.col("n")), 3) for i in (1, 2, 3)}
    v1, v2, v3 = (F.col(name) for name in parts)
    profile = F.create_map(
        *(F.lit(x) for (a, b, c), code in VOLUME_PROFILES.items() for x in (100 * a + 10 * b + c, code))
    )
    shape = rank_code(v1, v2, v3) * 100 + rank_code(v2, v1, v3) * 10 + rank_code(v3, v1, v2)
    return (
        stats.withColumns(
            {
                "peak_price": _price_peak(),
                "_up": _step_width("up") * F.col("up_steps"),
                "_down": _step_width("down") * F.col("down_steps"),
                **parts,
            }
        )
        .select(
            *_WINDOW,
            F.col("t_min").alias("ts_begin"),
            "peak_price",
            F.col("n").cast("int").alias("tickscnt"),
            F.when(long_enough, peak_code).otherwise(0).alias("frmconfpeak"),
            *(
                F.coalesce(half_up(ratio(F.col(side), moved), 3), F.lit(0.0)).alias(name)
                for side, name in (("_up", "sps"), ("_down", "sms"))
            ),
            F.coalesce(F.try_element_at(profile, shape), F.lit(0)).alias("tcvolprofile"),
            *(_autocorrelation(role).alias(role) for role in ROLES),
        )
    )


def window_features(
    ticks: DataFrame,
    windows: DataFrame,
    deep: int,
    lags: tuple[int, int, int] | None = None,
    slice_rows: int = SLICE_ROWS,
    block: int = BLOCK,
    **limits,
) -> DataFrame:
    """Features of every window that has ticks. ``windows`` should be a written table."""
    per_width = windows.groupBy("bar_width_sec").count().collect()  # one row per bar width
    widths = sorted(r["bar_width_sec"] for r in per_width)
    lags_of = {w: tuple(lags or default_lags(w)) for w in widths} or {0: tuple(lags or (1, 1, 1))}
    wanted = sorted({1, *(k for ks in lags_of.values() for k in ks)})
    bucket_ms = (widths or [1])[0] * 1000 * deep
    # A window of width w touches at most w / narrowest + 2 buckets.
    limits = {
        "at_most": sum(r["count"] * (r["bar_width_sec"] // widths[0] + 2) for r in per_width),
        **limits,
    }
    in_buckets = _in_buckets(windows, bucket_ms)
    read = of_days(ticks, _days_of_buckets(in_buckets, bucket_ms))
    whole = are_short(read, ["ticker_id"], min(block, slice_rows))
    if whole:  # no (instrument, bucket) can be hot
        limits = {"big_at_most": min(block, slice_rows), **limits}
    slim = read.select(
        "ticker_id",
        "ts",
        "db_tsunx",
        "ask",
        F.floor(F.col("db_tsunx") / bucket_ms).alias("bucket"),
    )
    touched = in_buckets.select("ticker_id", "bucket").distinct()
    slim = checked_join(
        slim, touched, ["ticker_id", "bucket"], "left_semi", spread=["db_tsunx", "ts"], **limits
    )
    lagged = durable(with_lags(slim, wanted, block, slice_rows, whole), "lagged-ticks")
    first = durable(
        match_windows(lagged, windows, bucket_ms, **limits)
        .groupBy(*_WINDOW, "from_ms")
        .agg(*_first_pass()),
        "form-moments",
    )
    extremes = [
        "t_min", "t_max", "low", "high", "up_min", "up_max", "down_min", "down_max",
    ]
    second = (
        match_windows(
            lagged.drop("seq"),
            first.select(*_WINDOW, "from_ms", *extremes),
            bucket_ms,
            **limits,
        )
        .groupBy(*_WINDOW)
        .agg(*_second_pass(lags_of))
    )
    return _finish(first.join(second, _WINDOW), deep)


def build_forms(
    ticks: DataFrame,
    kept: DataFrame,
    deep: int = 6,
    lags: tuple[int, int, int] | None = None,
    clip_to_first: bool = False,
    **options,
) -> DataFrame:
    """A row per kept bar with its features. A kept bar without any tick has count and features 0
    and ts_begin 0."""
    windows = durable(form_windows(kept, deep, clip_to_first), "form-windows")
    features = window_features(ticks, windows, deep, lags, **options)
    zero = {name: 0 for name in FORM_PROPS} | {"ts_begin": 0}
    return (
        kept.join(features, _WINDOW, "left")
        .fillna(zero)
        .withColumn("formdeepkoef", F.lit(deep))
    )


def complete(forms: DataFrame) -> DataFrame:
    """Forms that have ticks and whose ticks start early enough."""
    covered = F.col("ts_end") - F.col("ts_begin")
    needed = F.lit(1000) * (F.col("formdeepkoef") - 1) * F.col("bar_width_sec")
    return forms.where((F.col("ts_begin") != 0) & (covered >= needed))


def with_prop_map(forms: DataFrame) -> DataFrame:
    """Stored layout: the features as one string map."""
    pairs = [x for name in FORM_PROPS for x in (F.lit(name), F.col(name).cast("string"))]
    return forms.withColumn("formprops", F.create_map(*pairs)).select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in FORMS)
    )
