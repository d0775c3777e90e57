import math
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tickloom.functions.numeric import half_up
from tickloom.operators.bars import bars_dates_summary, bars_from_first_tick
from tickloom.schema import BARS

F1 = [(0, 1.0), (4000, 1.2), (9999, 1.1), (10000, 1.1), (25000, 1.3), (31000, 1.4)]


def items(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ticker_id long, bar_width_sec int")


def test_hand_computed_bars(spark, make_ticks):
    bars = bars_from_first_tick(make_ticks([(1, ms, p) for ms, p in F1]), items(spark, (1, 10)))
    assert bars.schema.names == BARS.names
    assert rows_of(bars, *[c for c in BARS.names if c != "ddate"]) == sorted(
        [
            (1, 10, 0, 9999, 1.0, 1.2, 1.0, 1.1, 0.1, 0.2, "g", 3, 0.08165, 0.09531),
            (1, 10, 10000, 20000, 1.1, 1.1, 1.1, 1.1, 0.0, 0.0, "n", 1, 0.0, 0.0),
            (1, 10, 25000, 35000, 1.3, 1.3, 1.3, 1.3, 0.0, 0.0, "n", 1, 0.0, 0.0),
        ],
        key=repr,
    )


def test_rounding_goes_up_on_negative_halves_and_nan_is_zero(spark):
    df = spark.createDataFrame([(-2.5,), (2.5,), (float("nan"),), (None,)], "v double")
    got = [r[0] for r in df.select(half_up(F.col("v"), 0)).collect()]
    assert got == [-2.0, 3.0, 0.0, None]


def test_empty_and_single_tick_give_no_bars(spark, make_ticks):
    one = make_ticks([(1, 5000, 1.0)])
    assert bars_from_first_tick(one, items(spark, (1, 10))).count() == 0
    assert bars_from_first_tick(one.limit(0), items(spark, (1, 10))).count() == 0


def naive_bars(ticks, width):
    """Per series, in plain Python: the definition."""
    out = []
    for ticker in {t[0] for t in ticks}:
        mine = sorted((t for t in ticks if t[0] == ticker), key=lambda t: t[1])
        t0, t1, w = mine[0][1], mine[-1][1], width * 1000
        side = t0
        while side + w <= t1:
            inside = [t for t in mine if side <= t[1] < side + w]
            if inside:
                mids = [(t[2] + t[3]) / 2 for t in inside]
                mean = sum(mids) / len(mids)
                out.append(
                    (
                        ticker,
                        inside[0][1],
                        inside[-1][1] if len(inside) > 1 else inside[0][1] + w,
                        round(mids[0], 5),
                        round(max(mids), 5),
                        round(min(mids), 5),
                        round(mids[-1], 5),
                        len(inside),
                        round(math.sqrt(sum((m - mean) ** 2 for m in mids) / len(mids)), 6),
                    )
                )
            side += w
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, {"small_rows": 0}, {"small_rows": 0, "hot_rows": 20}])
def test_bars_match_the_definition_on_every_join_path(spark, make_ticks, limits):
    rng = random.Random(5)
    ticks = []
    for ticker, n in ((1, 300), (2, 40), (3, 1)):
        for ms in sorted(rng.sample(range(900_000), n)):
            bid = rng.randint(100, 200) / 100
            ticks.append((ticker, ms, bid + 0.02, bid))
    bars = bars_from_first_tick(
        make_ticks(ticks), items(spark, (1, 30), (2, 30), (3, 30)), **limits
    )
    names = ("ticker_id", "ts_begin", "ts_end", "o", "h", "l", "c", "ticks_cnt", "disp")
    got = sorted(rows_of(bars, *names))
    assert [g[:3] + g[7:8] for g in got] == [n[:3] + n[7:8] for n in naive_bars(ticks, 30)]
    for g, n in zip(got, naive_bars(ticks, 30), strict=True):
        assert g[3:7] + g[8:] == pytest.approx(n[3:7] + n[8:], abs=1.1e-5)


def test_summary_counts_and_edges(spark, make_ticks):
    bars = bars_from_first_tick(make_ticks([(1, ms, p) for ms, p in F1]), items(spark, (1, 10)))
    assert rows_of(bars_dates_summary(bars), "cnt", "ts_end_min", "ts_end_max") == [
        (3, 9999, 35000)
    ]


@pytest.mark.parametrize("limits", [{}, {"small_rows": 0, "hot_rows": 20}])
def test_several_widths_give_the_bars_of_each_width_alone(spark, make_ticks, limits):
    rng = random.Random(8)
    ticks = make_ticks(
        [
            (t, ms, 60_000 + rng.randint(0, 300) / 100)
            for t, n in ((1, 300), (2, 30))
            for ms in sorted(rng.sample(range(1_500_000), n))
        ]
    )
    both = items(spark, (1, 30), (1, 40), (1, 120), (2, 40), (2, 120))
    together = bars_from_first_tick(ticks, both, fold_from=0, **limits)
    for width in (30, 40, 120):
        alone = bars_from_first_tick(ticks, both.where(F.col("bar_width_sec") == width))
        mine = together.where(F.col("bar_width_sec") == width)
        assert alone.count() > 5
        assert rows_of(mine, *BARS.names) == rows_of(alone, *BARS.names)
