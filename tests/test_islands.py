import random

from conftest import day_of, rows_of

from tickloom.operators.islands import island_ends, islands
from tickloom.plans.durable import durable
from tickloom.schema import OUTCOMES


def frame(spark, rows, width=1):
    """Rows (ticker, threshold, way, ts_end)."""
    return spark.createDataFrame(
        [(t, day_of(e), width, e, 1.0, p, e + 1, 0, day_of(e), 1.0, way) for t, p, way, e in rows],
        OUTCOMES,
    )


def test_hand_computed_runs(spark):
    rows = [(1, 0.1, "mx", s * 1000) for s in (1, 2, 3, 6, 7, 8, 11, 12, 15)]
    grouped = islands(frame(spark, rows), koeff=2)
    numbers = sorted((r.ts_end // 1000, r.grp) for r in grouped.collect())
    assert [g for _, g in numbers] == [1, 1, 1, 2, 2, 2, 3, 3, 4]
    ends = island_ends(frame(spark, rows), koeff=2)
    assert sorted(r.ts_end // 1000 for r in ends.collect()) == [3, 8, 12, 15]


def test_gap_equal_to_the_limit_splits(spark):
    assert island_ends(frame(spark, [(1, 0.1, "mx", 0), (1, 0.1, "mx", 2000)])).count() == 2


def test_other_ways_are_left_out(spark):
    rows = [(1, 0.1, "mx", 0), (1, 0.1, "bt", 1000), (1, 0.1, "mn", 1500)]
    assert rows_of(island_ends(frame(spark, rows)), "res_type") == [("mn",), ("mx",)]


def test_runs_over_many_days_equal_the_definition(spark):
    rng = random.Random(11)
    hour = 3600
    rows = []
    for t in (1, 2):
        for way in ("mx", "mn"):
            at = 0
            for _ in range(150):
                at += rng.choice([1, 1, 1, 2, 5, 30]) * hour * 1000
                rows.append((t, 0.1, way, at))
    expected = []
    for t in (1, 2):
        for way in ("mx", "mn"):
            ends = sorted(e for a, _, w, e in rows if a == t and w == way)
            expected += [
                (t, way, e)
                for e, after in zip(ends, [*ends[1:], None], strict=True)
                if after is None or (after - e) // 1000 >= 2 * hour
            ]
    got = rows_of(island_ends(frame(spark, rows, hour)), "ticker_id", "res_type", "ts_end")
    assert got == sorted(expected, key=repr)


def test_runs_of_short_series_take_one_shuffle(spark, capsys):
    rows = durable(frame(spark, [(t, 0.1, "mx", s * 1000) for t in (1, 2) for s in range(9)]), "short")
    island_ends(rows).explain()
    assert capsys.readouterr().out.count("Exchange") == 1
