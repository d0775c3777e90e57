import math
import random

import pytest
from conftest import day_of, rows_of

from tickloom.operators import forms as form_ops
from tickloom.operators.forms import build_forms, complete, form_windows, with_lags, with_prop_map
from tickloom.plans.durable import durable
from tickloom.schema import FORM_PROPS, OUTCOMES


def kept_frame(spark, rows):
    """Rows (ticker, width, ts_end)."""
    return spark.createDataFrame(
        [(t, day_of(e), w, e, 1.0, 0.1, e + 1, 0, day_of(e), 1.0, "mx") for t, w, e in rows],
        OUTCOMES,
    )


def up(x, n):
    return 0.0 if x != x else math.floor(x * 10**n + 0.5) / 10**n


def third(x, lo, hi):
    step = (hi - lo) / 3
    return 3 if x <= lo + step else 2 if x < lo + step + step else 1


def step_mass(moves):
    if not moves:
        return 0.0
    w = up((max(moves) - min(moves)) / 10, 6)
    return w * sum(m < min(moves) + 11 * w for m in moves)


def acf(asks, k):
    x, y = asks[k:], asks[: len(asks) - k]
    if not x:
        return 0.0
    mx, my = sum(x) / len(x), sum(y) / len(y)
    vx, vy = (sum((v - m) ** 2 for v in s) for s, m in ((x, mx), (y, my)))
    if vx * vy < 1e-18:
        return 0.0
    return sum((a - mx) * (b - my) for a, b in zip(x, y, strict=True)) / math.sqrt(vx * vy)


def expected_features(ticks, deep, width, end, lags):
    """ticks: (ms, ask) in form order, all of one instrument."""
    mine = [t for t in ticks if end - deep * width * 1000 <= t[0] <= end]
    if not mine:
        return None
    asks, times = [a for _, a in mine], [m for m, _ in mine]
    lo, hi, t0, t1 = min(asks), max(asks), times[0], times[-1]
    step = (hi - lo) / 10
    counts = [sum(lo + step * i <= a <= lo + step * (i + 1) for a in asks) for i in range(10)]
    peak = lo if step == 0 else lo + step * counts.index(max(counts))
    last = next(a for m, a in mine if m == t1)
    code = third(asks[0], lo, hi) * 100 + third(peak, lo, hi) * 10 + third(last, lo, hi)
    moves = [b - a for a, b in zip(asks, asks[1:])]
    rise = step_mass([m for m in moves if m > 0])
    fall = step_mass([-m for m in moves if m < 0])
    both = rise + fall
    s = (t1 - t0) // 3
    v = [
        up(n / len(mine), 3)
        for n in (
            sum(m <= t0 + s for m in times),
            sum(t0 + s <= m <= t0 + 2 * s for m in times),
            sum(m >= t0 + 2 * s for m in times),
        )
    ]
    ranks = tuple(
        1 if x > max(o) else 3 if x < min(o) else 2
        for x, o in ((v[i], v[:i] + v[i + 1 :]) for i in range(3))
    )
    return {
        "tickscnt": len(mine),
        "ts_begin": t0,
        "frmconfpeak": 0 if t1 - t0 < 1000 * (deep - 1) * width else code,
        "sps": up(rise / both, 3) if both else 0.0,
        "sms": up(fall / both, 3) if both else 0.0,
        "tcvolprofile": form_ops.VOLUME_PROFILES.get(ranks, 0),
        **{r: acf(asks, k) for r, k in zip(form_ops.ROLES, lags, strict=True)},
    }


def test_hand_computed_form(spark, make_ticks):
    ticks = make_ticks([(1, 0, 1.0), (1, 500, 1.3), (1, 1000, 1.31), (1, 2000, 1.9)])
    form = build_forms(ticks, kept_frame(spark, [(1, 1, 2000)]), deep=2, lags=(0, 1, 2)).first()
    assert form.tickscnt == 4
    assert form.peak_price == pytest.approx(1.27)
    assert form.frmconfpeak == 331
    assert (form.sps, form.sms, form.tcvolprofile) == (1.0, 0.0, 0)
    assert (form.acf_05_bws, form.acf_1_bws, form.acf_2_bws) == (1.0, 0.537, 1.0)


def test_default_lags_longer_than_the_form_give_zero(spark, make_ticks):
    ticks = make_ticks([(1, 1000 * i, 1.0 + i) for i in range(5)])
    form = build_forms(ticks, kept_frame(spark, [(1, 30, 4000)]), deep=1).first()
    assert (form.acf_05_bws, form.acf_1_bws, form.acf_2_bws) == (0.0, 0.0, 0.0)


def test_empty_single_and_flat_forms(spark, make_ticks):
    ticks = make_ticks(
        [(2, 5000, 1.5)] + [(3, 1000 * i, 2.0) for i in range(6)]  # one tick; flat price
    )
    kept = kept_frame(spark, [(1, 1, 5000), (2, 1, 5000), (3, 1, 5000)])
    got = {r.ticker_id: r for r in build_forms(ticks, kept, deep=3, lags=(1, 2, 4)).collect()}
    assert (got[1].tickscnt, got[1].ts_begin, got[1].frmconfpeak) == (0, 0, 0)
    assert (got[2].tickscnt, got[2].sps, got[2].sms, got[2].acf_1_bws) == (1, 0.0, 0.0, 0.0)
    assert (got[3].frmconfpeak, got[3].acf_1_bws) == (333, 0.0)
    assert rows_of(complete(build_forms(ticks, kept, 3, (1, 2, 4))), "ticker_id") == [(3,)]


def test_constant_prices_have_no_moves_and_no_correlation(spark, make_ticks):
    # Prices whose squares and sums do not fit a double exactly, and lengths that do not divide evenly.
    prices = [0.07, 0.1, 0.3, 1.1, 1.13507, 3.3, 99.99, 1234.56789, 33_333.333, 100_000.0]
    ticks = make_ticks([(t, 1000 * i, p, p) for t, p in enumerate(prices) for i in range(23 + t)])
    ends = [(t, 1, 1000 * (22 + t)) for t in range(len(prices))]
    got = build_forms(ticks, kept_frame(spark, ends), deep=20, lags=(1, 2, 4)).collect()
    assert len(got) == len(prices)
    for r in got:
        assert (r.frmconfpeak, r.sps, r.sms) == (333, 0.0, 0.0), r
        assert (r.acf_05_bws, r.acf_1_bws, r.acf_2_bws) == (0.0, 0.0, 0.0), r


@pytest.mark.parametrize(
    "options", [{}, {"small_rows": 0, "hot_rows": 15, "slice_rows": 10, "block": 7}]
)
def test_features_equal_the_definition(spark, make_ticks, options):
    """Several widths, overlapping windows, a busy instrument, equal milliseconds."""
    rng = random.Random(23)
    rows, series = [], {}
    for ticker, n in ((1, 400), (2, 60)):
        times = sorted(rng.randrange(200_000) for _ in range(n))
        for i, ms in enumerate(times):
            rows.append((ticker, ms, rng.randint(100, 160) / 100, 1.0, ms * 1000 + i))
        # Form order: by ms, and within a millisecond the newest ts first.
        series[ticker] = [
            (r[1], r[2])
            for r in sorted((r for r in rows if r[0] == ticker), key=lambda r: (r[1], -r[4]))
        ]
    ends = [(t, w, e) for t in (1, 2) for w in (5, 15) for e in range(30_000, 200_000, 17_000)]
    forms = build_forms(
        make_ticks(rows), kept_frame(spark, ends), deep=3, lags=(1, 2, 4), **options
    )
    got = {(r.ticker_id, r.bar_width_sec, r.ts_end): r for r in forms.collect()}
    assert len(got) == len(ends)
    for ticker, width, end in ends:
        want = expected_features(series[ticker], 3, width, end, (1, 2, 4))
        form = got[ticker, width, end]
        if want is None:
            assert form.tickscnt == 0
            continue
        for name, value in want.items():
            assert form[name] == pytest.approx(value, abs=6e-4), (ticker, width, end, name)


@pytest.mark.parametrize("block", [5, 1000])
def test_lags_cross_slices_and_blocks(spark, make_ticks, block):
    rows = [(t, i * 700_000, float(i)) for t in (1, 2) for i in range(30)]
    lagged = with_lags(make_ticks(rows), [1, 4], block=block, slice_rows=3)
    for r in lagged.collect():
        assert r.ask_1 == (r.seq - 1 if r.seq >= 1 else None)
        assert r.ask_4 == (r.seq - 4 if r.seq >= 4 else None)
    assert lagged.count() == 60


def test_clipped_windows_start_at_the_first_kept_bar(spark):
    kept = kept_frame(spark, [(1, 10, 50_000), (1, 10, 90_000)])
    assert rows_of(form_windows(kept, 6, clip_to_first=True), "ts_end", "from_ms") == [
        (50_000, 50_000),
        (90_000, 50_000),
    ]


def test_prop_map_round_trip(spark, make_ticks):
    from tickloom.sources.tables import typed_forms

    ticks = make_ticks([(1, 1000 * i, 1.0 + i % 3) for i in range(8)])
    forms = durable(build_forms(ticks, kept_frame(spark, [(1, 1, 7000)]), 3, (1, 2, 4)), "f")
    back = typed_forms(with_prop_map(forms))
    assert rows_of(back, *FORM_PROPS) == rows_of(forms, *FORM_PROPS)
