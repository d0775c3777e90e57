import random

from conftest import rows_of

from tickloom.operators.bars import bars_from_first_tick
from tickloom.operators.meta import last_bars, resume_points, tick_edges
from tickloom.operators.resume import bars_chained, bars_resumed, read_windows, resume_step

F1 = [(0, 1.0), (4000, 1.2), (9999, 1.1), (10000, 1.1), (25000, 1.3), (31000, 1.4)]
BAR = ("ticker_id", "ts_begin", "ts_end", "o", "h", "l", "c", "ticks_cnt")


def items(spark, *tickers, width=10):
    return spark.createDataFrame([(t, width) for t in tickers], "ticker_id long, bar_width_sec int")


def no_bars(ticks, work):
    return bars_from_first_tick(ticks.limit(0), work)


def test_resume_point_falls_back_from_bar_to_first_tick_to_zero(spark, make_ticks):
    ticks = make_ticks([(1, ms, p) for ms, p in F1] + [(2, 7000, 1.0)])
    work = items(spark, 1, 2, 3)
    bars = bars_from_first_tick(ticks, items(spark, 1))
    points = resume_points(work, last_bars(bars), tick_edges(ticks))
    assert rows_of(points, "ticker_id", "begin_from", "lag_sec") == [
        (1, 35000, -4),
        (2, 7000, 0),
        (3, 0, 0),
    ]


def naive_window(times, begin, width_ms, step):
    """Read, and read one step further while that is not enough."""
    newest, to = times[-1], min(begin + step, times[-1])
    while True:
        got = [t for t in times if begin <= t <= to]
        short = not got or got[-1] - got[0] < width_ms
        if newest > to and short:
            to += step
            continue
        return to


def test_read_windows_equal_repeated_reading(spark, make_ticks):
    rng = random.Random(7)
    series = {
        t: sorted(rng.sample(range(400_000), rng.choice([1, 3, 12]))) for t in range(1, 31)
    }
    ticks = make_ticks([(t, ms, 1.0) for t, times in series.items() for ms in times])
    begins = {t: rng.choice(times) + rng.choice([0, 0, 5000]) for t, times in series.items()}
    points = spark.createDataFrame(
        [(t, 10, begins[t], series[t][-1]) for t in series],
        "ticker_id long, bar_width_sec int, begin_from long, last_tick_ts long",
    )
    got = {r.ticker_id: r.read_to for r in read_windows(ticks, points, 20_000).collect()}
    for t, times in series.items():
        if begins[t] <= times[-1]:
            assert got[t] == naive_window(times, begins[t], 10_000, 20_000), t


def test_tick_on_the_border_belongs_to_both_bars(spark, make_ticks):
    ticks = make_ticks([(1, ms, p) for ms, p in F1])
    work = items(spark, 1)
    first = bars_resumed(ticks, no_bars(ticks, work), work, 15_000)
    assert rows_of(first, "ts_begin", "ts_end") == [(0, 9999)]
    second = bars_resumed(ticks, first, work, 15_000)
    # The bar starts again at 9999, the end of the bar before.
    assert rows_of(second, "ts_begin", "ts_end", "ticks_cnt") == [
        (25_000, 35_000, 1),
        (9999, 10_000, 2),
    ]


def test_chain_equals_steps_taken_by_hand(spark, make_ticks):
    rng = random.Random(2)
    rows = []
    for t, n in ((1, 60), (2, 8)):
        rows += [(t, ms, rng.randint(100, 130) / 100) for ms in sorted(rng.sample(range(120_000), n))]
    ticks, work = make_ticks(rows), items(spark, 1, 2)
    chained = bars_chained(ticks, work, 60_000)
    edges, bars = tick_edges(ticks), no_bars(ticks, work)
    for _ in range(20):
        windows = read_windows(ticks, resume_points(work, last_bars(bars), edges), 60_000)
        fresh = resume_step(ticks, windows).collect()
        if not fresh:
            break
        bars = spark.createDataFrame(bars.collect() + fresh, bars.schema)
    assert rows_of(chained, *BAR) == rows_of(bars, *BAR)
    assert chained.count() > 5



def test_ticks_before_an_inflated_bar_end_are_skipped_for_good(spark, make_ticks):
    ticks = make_ticks([(1, ms, p) for ms, p in F1])
    work = items(spark, 1)
    bars = bars_from_first_tick(ticks, work)  # the last bar is inflated to 35000
    later = make_ticks([(1, ms, p) for ms, p in [*F1, (36_000, 1.5), (50_000, 1.6)]])
    added = bars_resumed(later, bars, work)
    assert rows_of(added, "ts_begin", "ts_end") == [(36_000, 46_000)]  # not 31000


def test_several_ticks_in_the_last_millisecond_end_the_chain(spark, make_ticks):
    rows = [(1, 0, 1.0), (1, 5000, 1.1, 1.1, 1), (1, 5000, 1.2, 1.2, 2), (1, 40_000, 1.3)]
    bars = bars_chained(make_ticks(rows), items(spark, 1))
    assert len({(r.ts_end) for r in bars.collect()}) == bars.count()
