"""Outcomes in several runs against one run over all bars."""

import datetime
import random

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from tickloom.operators import opensearch, pricecells
from tickloom.operators.outcomes import first_hits, resolved
from tickloom.plans import jobs
from tickloom.plans.durable import durable
from tickloom.schema import BARS, OPEN_SEARCHES, OUTCOMES
from tickloom.sinks import tables as sinks

DAY = 86_400_000
KEYS = ["ticker_id", "bar_width_sec", "log_oe", "ts_end", "ts_end_res", "res_type"]


def bar(ticker, day, at, c, spread=0.0):
    values = {
        "ticker_id": ticker, "ddate": datetime.date(1970, 1, 1) + datetime.timedelta(day), "bar_width_sec": 30,
        "ts_begin": day * DAY + at * 30_000, "ts_end": day * DAY + at * 30_000 + 30_000,
        "o": c, "h": None if c is None else c + spread, "l": None if c is None else c - spread, "c": c,
    }
    return tuple(values.get(f) for f in BARS.names)


def random_bars(seed, days=range(1, 9), tickers=(1, 2, 3)):
    rng = random.Random(seed)
    out = []
    for t in tickers:
        c = 1.0
        for d in days:
            for at in range(rng.randrange(1, 6)):
                c = round(c * (1 + rng.choice([-0.011, -0.004, 0, 0.004, 0.011])), 4)
                out.append(bar(t, d, at, c, rng.choice([0, 0.001, 0.02])))
    return out


def rows_of(df, columns=KEYS):
    return sorted(map(str, df.select(*columns).collect()))


def one_run(spark, rows, thresholds):
    return rows_of(resolved(first_hits(spark.createDataFrame(rows, BARS), thresholds)))


@pytest.fixture
def store(spark, tmp_path):
    return jobs.Store(spark, str(tmp_path / "store"))


def save(store, rows):
    rows = store.spark.createDataFrame(rows, BARS)
    sinks.save_bars(rows, store.path("bars"), store.path("bars_bws_dates"))


def test_runs_add_up_to_one_run(store):
    rows = random_bars(3)
    # A ticker that stops early, one whose first bar never resolves, one without prices.
    rows += [bar(4, 1, 0, 5.0), bar(4, 1, 1, 5.0)]
    rows += [bar(5, 1, 0, 900.0), *(bar(5, d, 0, 1.0 + d / 100) for d in range(2, 9))]
    rows += [bar(6, d, 0, None) for d in range(1, 9)]
    for last in (4, 9):
        part = [r for r in rows if last - 5 <= (r[1] - datetime.date(1970, 1, 1)).days <= last]
        save(store, part)
        jobs.build_outcomes(store, [0.01, 0.05])
    assert rows_of(store.read("bars_fa")) == one_run(store.spark, rows, [0.01, 0.05])
    # Every pair is either resolved or open, once.
    assert store.read("bars_fa").count() + jobs.open_searches(store).count() == 2 * len(rows)
    jobs.build_outcomes(store, [0.01, 0.05])
    assert store.read("bars_fa").count() + jobs.open_searches(store).count() == 2 * len(rows)


def test_thresholds_that_were_searched_at_different_times(store):
    rows = random_bars(5, tickers=(1, 2))
    early = [r for r in rows if r[1] < datetime.date(1970, 1, 5)]
    save(store, early)
    jobs.build_outcomes(store, [0.01])
    save(store, [r for r in rows if r not in early])
    jobs.build_outcomes(store, [0.03])
    jobs.build_outcomes(store, [0.01, 0.03])
    assert rows_of(store.read("bars_fa")) == one_run(store.spark, rows, [0.01, 0.03])


def test_hot_series_and_split_joins(spark):
    rows = random_bars(7)
    bars = spark.createDataFrame(rows, BARS)
    old = bars.where(F.col("ddate") <= "1970-01-05")
    nothing = spark.createDataFrame([], OPEN_SEARCHES)
    split = {"hot_rows": 3, "small_rows": 0}
    first, waiting = opensearch.outcomes_resumed(old, nothing, [0.01], **split)
    second, _ = opensearch.outcomes_resumed(bars, waiting, [0.01], **split)
    assert rows_of(first.unionByName(second)) == one_run(spark, rows, [0.01])


def test_a_second_run_reads_only_days_with_newer_bars(store):
    rows = random_bars(9, tickers=(1,)) + [bar(2, 1, 0, 5.0)]  # ticker 2 stopped long ago
    save(store, rows)
    jobs.build_outcomes(store, [0.01])
    save(store, [bar(1, 9, 0, 1.3), bar(1, 9, 1, 0.7)])
    found = jobs.bars_not_searched(store, jobs.open_searches(store), [0.01])
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("]")[0]
    assert "1970-01-10" in filters and "1970-01-0" not in filters


def test_a_run_that_ends_before_its_open_searches_are_noted(store, monkeypatch):
    rows = random_bars(11, tickers=(1, 2))
    early = [r for r in rows if r[1] < datetime.date(1970, 1, 5)]
    save(store, early)
    jobs.build_outcomes(store, [0.01])
    save(store, [r for r in rows if r not in early])
    before = rows_of(jobs.open_searches(store), OPEN_SEARCHES.names)
    half = jobs.open_searches(store).limit(1)
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "OPEN_RUNS", "not a schema (")
        patch.setattr(sinks, "_last_run", lambda *_: 1)
        with pytest.raises(ParseException):  # the rows are written, their run is never noted
            sinks.save_open(half, *map(store.path, jobs._OPEN_TABLES))
    assert rows_of(jobs.open_searches(store), OPEN_SEARCHES.names) == before
    jobs.build_outcomes(store, [0.01])
    assert rows_of(store.read("bars_fa")) == one_run(store.spark, rows, [0.01])


def test_no_bars_and_no_open_searches(spark):
    empty = spark.createDataFrame([], BARS)
    found, left = opensearch.outcomes_resumed(empty, spark.createDataFrame([], OPEN_SEARCHES), [0.01])
    assert found.count() == left.count() == 0
    assert found.columns == OUTCOMES.names and left.columns == OPEN_SEARCHES.names


def test_open_searches_go_down_the_tree(spark, monkeypatch):
    """Short series answer open searches from one sibling list, without price cells of any level."""

    def refused(*_):
        raise AssertionError("price cells")

    monkeypatch.setattr(pricecells, "_search_blocks", refused)
    rows = [bar(1, 1, 0, 1.0), bar(1, 1, 1, 1.004), bar(1, 2, 0, 1.0101, 0.001), bar(2, 1, 0, 5.0)]
    none = spark.createDataFrame([], OPEN_SEARCHES)
    found, left = opensearch.outcomes_resumed(spark.createDataFrame(rows[:2], BARS), none, [0.01])
    left = durable(left, "left")
    newer = spark.createDataFrame(rows[2:], BARS)
    more, still = opensearch.outcomes_resumed(newer, left, [0.01])
    assert rows_of(found.unionByName(more)) == one_run(spark, rows, [0.01])
    assert len(rows_of(found.unionByName(more))) == 1 and still.count() == 3
