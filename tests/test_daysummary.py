"""The stored day summary: kept up by loads, safe against a load that breaks off, and what it saves."""

import random
import re

import pytest
from conftest import rows_of

from tickloom.operators import daysummary, meta, resume
from tickloom.plans import days as day_plans
from tickloom.plans import jobs
from tickloom.schema import SERIES
from tickloom.sinks import tables as sinks

DAY = 86_400_000
COLUMNS = ["ticker_id", "ddate", "ticks_count", "first_ts", "last_ts", "min_tsunx", "max_tsunx"]


@pytest.fixture()
def some_ticks(make_ticks):
    rng = random.Random(4)
    rows = {(rng.randrange(5), DAY * 100 + rng.randrange(12 * DAY)) for _ in range(600)}
    return make_ticks([(t, ms, 1.0) for t, ms in sorted(rows)])


def stated_days(df):
    """Days named in the partition filters of the scans of a plan, one set per scan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    return [set(re.findall(r"\d{4}-\d\d-\d\d", x)) for x in filters]


def loaded(spark, path, *parts):
    store = jobs.Store(spark, str(path))
    for part in parts:
        jobs.load_ticks(store, part)
    return store


def test_overlapping_loads_keep_the_summary(spark, tmp_path, some_ticks):
    early, late = some_ticks.where("ddate <= '1970-04-17'"), some_ticks.where("ddate >= '1970-04-15'")
    store = loaded(spark, tmp_path / "s", early, late, early)
    want = rows_of(daysummary.day_summary(some_ticks), *COLUMNS)
    assert rows_of(store.read_own("ticks_days"), *COLUMNS) == want
    assert store.read_own("ticks_pending").isEmpty()
    totals = rows_of(daysummary.total_counts(jobs.tick_days(store)), "ticker_id", "ticks_count")
    assert totals == rows_of(some_ticks.groupBy("ticker_id").count(), "ticker_id", "count")


def test_only_touched_days_are_rebuilt(spark, tmp_path, some_ticks, monkeypatch):
    store = loaded(spark, tmp_path / "s", some_ticks)
    rebuilt = []
    plain = sinks.day_summary
    monkeypatch.setattr(sinks, "day_summary", lambda t: rebuilt.append(stated_days(t)) or plain(t))
    jobs.load_ticks(store, some_ticks.where("ddate = '1970-04-16'"))
    assert rebuilt == [[{"1970-04-16"}]]


def test_a_load_that_breaks_off_is_made_up_for(spark, tmp_path, some_ticks, monkeypatch):
    first, second = some_ticks.where("ticker_id < 3"), some_ticks.where("ticker_id >= 3")
    store = loaded(spark, tmp_path / "s", first)
    with monkeypatch.context() as m:
        m.setattr(sinks, "refresh_days", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            jobs.load_ticks(store, second)
    want = rows_of(daysummary.day_summary(some_ticks), *COLUMNS)
    assert rows_of(store.read_own("ticks_days"), *COLUMNS) != want
    assert rows_of(jobs.tick_days(store), *COLUMNS) == want
    jobs.load_ticks(store, second.limit(1))  # any later load takes the pending days along
    assert rows_of(store.read_own("ticks_days"), *COLUMNS) == want


def test_a_store_without_a_summary_works_it_out(spark, tmp_path, some_ticks):
    store = jobs.Store(spark, str(tmp_path / "s"))
    assert jobs.tick_days(store).isEmpty()
    sinks.save_ticks(some_ticks, store.path("ticks"))
    want = rows_of(daysummary.day_summary(some_ticks), *COLUMNS)
    assert rows_of(jobs.tick_days(store), *COLUMNS) == want


def test_edges_come_from_the_summary_alone(spark, tmp_path, some_ticks):
    store = loaded(spark, tmp_path / "s", some_ticks)
    edges = daysummary.edges(jobs.tick_days(store))
    assert edges.inputFiles() and all("/ticks_days/" in f for f in edges.inputFiles())
    columns = ["ticker_id", "first_ts", "last_tick_ts"]
    assert rows_of(edges, *columns) == rows_of(meta.tick_edges(some_ticks), *columns)


def test_first_tick_from_against_a_full_scan(spark, some_ticks):
    rng = random.Random(9)
    marks = [(t, w, DAY * 100 + rng.randrange(-DAY, 13 * DAY)) for t in range(6) for w in (10, 60)]
    marks += [(1, 99, None)]
    windows = spark.createDataFrame(marks, "ticker_id long, bar_width_sec int, begin long")
    got = daysummary.first_tick_from(
        some_ticks, daysummary.day_summary(some_ticks), windows, "begin", "found"
    )
    ticks = [(r.ticker_id, r.db_tsunx) for r in some_ticks.collect()]

    def first(t, begin):
        return min((ms for x, ms in ticks if x == t and begin is not None and ms >= begin), default=None)

    want = sorted(((t, w, first(t, b)) for t, w, b in marks), key=repr)
    assert rows_of(got, *SERIES, "found") == want


def test_a_stale_instrument_does_not_widen_the_read(spark, tmp_path, make_ticks, monkeypatch):
    """Instrument 2 stopped on the first of 30 days; a resume step at the end reads the newest days
    of instrument 1 and that one day, and says so as literal days."""
    start = 200 * DAY
    rows = [(1, start + d * DAY + h * 3_600_000, 1.0 + h) for d in range(30) for h in range(0, 24, 3)]
    rows += [(2, start + h * 60_000, 2.0) for h in range(30)]
    ticks = make_ticks(rows)
    store = loaded(spark, tmp_path / "s", ticks)
    items = spark.createDataFrame([(1, 3600), (2, 600)], "ticker_id long, bar_width_sec int")
    newest = [(1, 3600, start + 28 * DAY + 5), (2, 600, start + 600_000)]
    bars = spark.createDataFrame(newest, "ticker_id long, bar_width_sec int, ts_end long")
    bars = bars.selectExpr("*", "cast(timestamp_millis(ts_end) as date) as ddate")
    reads = []
    plain = day_plans.of_days

    def spied(stored, rows):
        out = plain(stored, rows)
        reads.append(stated_days(out))
        return out

    monkeypatch.setattr(resume, "of_days", spied)
    monkeypatch.setattr(daysummary, "of_days", spied)
    found = resume.bars_resumed(store.read("ticks"), bars, items, DAY, jobs.tick_days(store))
    want = resume.bars_resumed(ticks, bars, items, DAY)
    columns = [*SERIES, "ts_begin", "ts_end", "o", "c", "ticks_cnt"]
    assert rows_of(found, *columns) == rows_of(want, *columns) != []
    stated = [days for scan in reads[:3] for days in scan]
    assert len(stated) == 3 and all(stated)
    assert set().union(*stated) <= {"1970-07-20", "1970-08-17", "1970-08-18"}
