import random

import pytest
from conftest import rows_of

from tickloom.operators.bars import bars_from_first_tick
from tickloom.schema import BARS, TICKS
from tickloom.streaming import bars_stream

COLUMNS = [c for c in BARS.names if c not in ("disp", "log_co")]


@pytest.fixture
def stream_of(spark, tmp_path):
    """Write batches of ticks as files in order and stream them one file per batch."""

    def run(batches, items, lateness_ms=0):
        source, folder = tmp_path / "in", str(tmp_path / "out")
        source.mkdir(exist_ok=True)
        for batch in batches:
            batch.coalesce(1).write.mode("append").parquet(str(source))
            ticks = (
                spark.readStream.schema(TICKS)
                .option("maxFilesPerTrigger", 1)
                .parquet(str(source))
            )
            # A new start per batch: progress and state carry over a restart.
            bars_stream.start(ticks, items, folder, lateness_ms).awaitTermination()
        return bars_stream.closed_bars(spark, folder), folder

    return run


def items(spark, *tickers):
    return spark.createDataFrame([(t, 10) for t in tickers], "ticker_id long, bar_width_sec int")


def test_stream_equals_batch(spark, make_ticks, stream_of):
    rng = random.Random(4)
    rows = []
    for ticker, n in ((1, 200), (2, 30), (3, 1)):
        rows += [
            (ticker, ms, rng.randint(100, 150) / 100, 1.0)
            for ms in rng.sample(range(300_000), n)
        ]
    rows.sort(key=lambda r: r[1])
    cuts = [0, 50, 51, 140, len(rows)]
    batches = [make_ticks(rows[a:b]) for a, b in zip(cuts, cuts[1:])]
    work = items(spark, 1, 2, 3)
    streamed, _ = stream_of(batches, work)
    batch = bars_from_first_tick(make_ticks(rows), work)
    assert rows_of(streamed, *COLUMNS) == rows_of(batch, *COLUMNS)
    for a, b in zip(rows_of(streamed, "ticker_id", "ts_begin", "disp"), rows_of(batch, "ticker_id", "ts_begin", "disp"), strict=True):
        assert a == pytest.approx(b, abs=1.1e-6)


def test_late_ticks_are_dropped_and_counted(spark, make_ticks, stream_of):
    first = [(1, ms, 1.0) for ms in (0, 4000, 12_000, 25_000)]
    late = [(1, 3000, 9.0), (1, 26_000, 1.1), (1, 31_000, 1.2)]
    bars, folder = stream_of([make_ticks(first), make_ticks(late)], items(spark, 1))
    assert rows_of(bars, "ts_begin", "h", "ticks_cnt") == [
        (0, 1.0, 2),
        (12_000, 1.0, 1),
        (25_000, 1.1, 2),
    ]
    state = bars_stream.series_state(spark, folder, 1).collect()
    assert [(r.late, r.closed_to) for r in state] == [(1, 30_000)]


def test_allowed_lateness_keeps_buckets_open(spark, make_ticks, stream_of):
    first = [(1, ms, 1.0) for ms in (0, 4000, 12_000)]
    late = [(1, 3000, 9.0), (1, 40_000, 1.1)]
    bars, folder = stream_of([make_ticks(first), make_ticks(late)], items(spark, 1), 15_000)
    assert rows_of(bars, "ts_begin", "h", "ticks_cnt") == [(0, 9.0, 3), (12_000, 1.0, 1)]
    assert bars_stream.series_state(spark, folder, 1).first().late == 0


def test_running_a_batch_again_changes_nothing(spark, make_ticks, tmp_path):
    folder, work = str(tmp_path), items(spark, 1)
    one = make_ticks([(1, 0, 1.0), (1, 12_000, 1.1)])
    two = make_ticks([(1, 13_000, 1.2), (1, 40_000, 1.3)])
    bars_stream.update(one, 0, work, folder)
    bars_stream.update(two, 1, work, folder)
    before = rows_of(bars_stream.closed_bars(spark, folder), *BARS.names)
    bars_stream.update(two, 1, work, folder)
    assert rows_of(bars_stream.closed_bars(spark, folder), *BARS.names) == before
    assert len(before) == 2
