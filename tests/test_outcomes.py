import math
import random

import pytest
from conftest import day_of, rows_of

from tickloom.operators.outcomes import bars_to_analyse, first_hits, resolved
from tickloom.schema import BARS


def bars_frame(spark, rows):
    """Rows (ticker, ts_begin, ts_end, low, high, close)."""
    full = [
        (t, day_of(e), 10, b, e, c, hi, lo, c, 0.0, 0.0, "n", 2, 0.0, 0.0)
        for t, b, e, lo, hi, c in rows
    ]
    return spark.createDataFrame(full, BARS)


def up4(x):
    return math.floor(x * 10000 + 0.5) / 10000


def brute(rows, thresholds):
    out = []
    for t in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == t), key=lambda r: (day_of(r[2]), r[2], r[1]))
        for i, (_, b, e, _, _, c) in enumerate(mine):
            for p in thresholds:
                up, dn = up4(math.exp(math.log(c) + p)), up4(math.exp(math.log(c) - p))
                hit = next(
                    (
                        (r, "mx" if r[3] <= up <= r[4] else "mn")
                        for r in mine[i + 1 :]
                        if r[3] <= up <= r[4] or r[3] <= dn <= r[4]
                    ),
                    None,
                )
                out.append((t, b, p, hit[0][2] if hit else None, hit[1] if hit else "nn"))
    return sorted(out, key=repr)


COLUMNS = ("ticker_id", "ts_begin", "log_oe", "ts_end_res", "res_type")


@pytest.mark.parametrize(
    ("later", "expected"),
    [
        ([(0.95, 1.05)], "nn"),
        ([(0.95, 1.05), (1.11, 1.20)], "nn"),  # gapped past the target
        ([(1.11, 1.20), (0.90, 1.12)], "mx"),  # holds both targets
        ([(1.11, 1.20), (0.90, 1.00)], "mn"),
    ],
)
def test_hand_computed_outcomes(spark, later, expected):
    rows = [(1, 0, 9, 1.0, 1.0, 1.0)] + [
        (1, 10 * i, 10 * i + 9, lo, hi, hi) for i, (lo, hi) in enumerate(later, 1)
    ]
    hits = first_hits(bars_frame(spark, rows), [0.1])
    first = hits.where("ts_begin = 0").collect()[0]
    assert first.res_type == expected
    assert resolved(hits).where("ts_end = 9").count() == (0 if expected == "nn" else 1)


def random_rows(rng, sizes):
    rows = []
    for t, n in sizes.items():
        price = 1.0
        for i in range(n):
            price *= math.exp(rng.gauss(0, 0.02))
            spread = rng.choice([0.0, 0.0, 0.005, 0.02])
            c = round(price, 5)
            rows.append(
                (t, i * 40_000_000, i * 40_000_000 + 9000, round(c - spread, 5), round(c + spread, 5), c)
            )
    return rows


@pytest.mark.parametrize(
    "options",
    [{}, {"fanout": 4}, {"fanout": 4, "hot_rows": 5}, {"max_rounds": 0}, {"fanout": 4, "max_rounds": 1}],
)
def test_search_equals_the_definition(spark, options):
    rows = random_rows(random.Random(3), {1: 60, 2: 20, 3: 1})
    hits = first_hits(bars_frame(spark, rows), [0.03, 0.2], **options)
    assert rows_of(hits, *COLUMNS) == brute(rows, [0.03, 0.2])
    assert hits.where("res_type = 'bt'").count() == 0


def test_flat_points_with_gaps_never_hit(spark):
    """Every hull spans the targets, no bar holds one: the search must end with nothing found."""
    rows = [(1, i * 10, i * 10 + 9, p, p, p) for i, p in enumerate([0.5, 2.0] * 20)]
    hits = first_hits(bars_frame(spark, rows), [0.1], fanout=3)
    assert hits.count() == 40
    assert {r.res_type for r in hits.collect()} == {"nn"}


def test_no_bars(spark):
    assert first_hits(bars_frame(spark, []), [0.1]).count() == 0


def test_stored_order_can_give_negative_durations_grid_order_cannot(spark):
    # The single-tick bar starts first but its inflated end comes last.
    rows = [(1, 0, 30_000, 1.0, 1.0, 1.0), (1, 5_000, 20_000, 0.9, 1.2, 1.0)]
    stored = resolved(first_hits(bars_frame(spark, rows), [0.1]))
    assert stored.count() == 0
    grid = resolved(first_hits(bars_frame(spark, rows), [0.1], order="grid"))
    assert rows_of(grid, "ts_end", "ts_end_res", "dursec_res") == [(30_000, 20_000, -10)]


def test_restart_reads_from_the_last_analysed_day(spark):
    day = 86_400_000
    bars = bars_frame(spark, [(1, i * day, i * day + 5, 1.0, 1.2, 1.0) for i in range(4)])
    done = resolved(first_hits(bars, [0.1])).where("ddate <= date '1970-01-02'")
    assert rows_of(bars_to_analyse(bars, done), "ts_begin") == [(2 * day,), (3 * day,), (day,)]
    assert bars_to_analyse(bars).count() == 4
    assert rows_of(bars_to_analyse(bars, latest_only=True), "ts_begin") == [(3 * day,)]


def test_price_cells_respect_range_ends_and_slices(spark, monkeypatch):
    """Targets on the very edge of a range, points on and off the grid, answers slices away."""
    from tickloom.operators import pricecells

    monkeypatch.setattr(pricecells, "SLICE", 4)
    up, down = up4(math.exp(0.1)), up4(math.exp(-0.1))
    rows = [(1, 0, 9, 1.0, 1.0, 1.0)]
    rows += [(1, 10 * i, 10 * i + 9, 1.10515, 1.10515, 1.10515) for i in range(1, 20)]
    rows += [(1, 300, 309, up, up + 0.3, up), (1, 400, 409, down - 0.2, down, down)]
    hits = first_hits(bars_frame(spark, rows), [0.1], max_rounds=0)
    assert rows_of(hits, *COLUMNS) == brute(rows, [0.1])


def test_negative_thresholds_are_refused(spark):
    with pytest.raises(ValueError):
        first_hits(bars_frame(spark, []), [-0.1])
