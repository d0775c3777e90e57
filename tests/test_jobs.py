import datetime
import random

import pytest
from conftest import rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickloom.operators.outcomes import resolved
from tickloom.plans import jobs
from tickloom.schema import BARS, KEYS, OUTCOMES
from tickloom.sinks import tables as sinks
from tickloom.sources import tables, ticks as tick_ops

DAY = 86_400_000


@pytest.fixture(scope="module")
def market(make_ticks):
    rng = random.Random(9)
    rows = []
    for ticker in (1, 2, 5):
        price = 1.5
        for ms in sorted(rng.sample(range(5 * DAY), 500)):
            price *= 1 + rng.gauss(0, 0.01)
            rows.append((ticker, ms, round(price + 0.0002, 5), round(price, 5)))
    return rows


@pytest.fixture
def store(spark, tmp_path, market, make_ticks):
    s = jobs.Store(spark, str(tmp_path))
    ticks = make_ticks(market)
    jobs.load_ticks(s, ticks.where(F.col("db_tsunx") < 3 * DAY))
    spark.createDataFrame(
        [(t, f"T{t}", "A", "B") for t in (1, 2, 3, 5)],
        "ticker_id long, ticker_code string, ticker_first string, ticker_seconds string",
    ).write.parquet(s.path("tickers"))
    tables.bars_property_for(ticks, [1800]).write.parquet(s.path("bars_property"))
    return s


def test_tick_load_is_idempotent_and_counts_what_is_stored(store, market, make_ticks):
    early = store.read("ticks").count()
    jobs.load_ticks(store, make_ticks(market))
    jobs.load_ticks(store, make_ticks(market))
    ticks = store.read("ticks")
    assert early < ticks.count() == len(market)
    assert tables.ticks_count_days(ticks).agg(F.sum("ticks_count")).first()[0] == len(market)
    assert rows_of(tables.ticks_count_total(ticks), "ticks_count") == [(500,)] * 3


def test_whole_chain_and_a_second_run(store, market, make_ticks):
    jobs.build_bars(store, "first_tick")
    assert rows_of(store.read("bars").select("ticker_id").distinct(), "ticker_id") == [(1,), (2,)]
    jobs.build_outcomes(store, [0.02])
    first_outcomes = store.read("bars_fa").count()
    jobs.build_forms(store, [0.02], lags=(1, 2, 4))
    forms = store.read("bars_forms")
    before = rows_of(forms, *KEYS["bars_forms"])
    assert len(before) > 10
    jobs.load_ticks(store, make_ticks(market))
    jobs.build_bars(store, "resume", step_sec=3600)
    jobs.build_bars(store, "resume", step_sec=86_400)
    jobs.build_outcomes(store, [0.02])
    jobs.build_forms(store, [0.02], lags=(1, 2, 4))
    after = rows_of(store.read("bars_forms"), *KEYS["bars_forms"])
    assert set(before) <= set(after) and len(after) > len(before)
    assert store.read("bars_fa").count() > first_outcomes
    for name in ("bars", "bars_fa", "bars_forms"):
        table = store.read(name)
        assert table.count() == table.dropDuplicates(KEYS[name]).count()
    summary = store.read("bars_bws_dates")
    assert summary.agg(F.sum("cnt")).first()[0] >= store.read("bars").count()


def test_unknown_mode_and_empty_save_are_refused(store, spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.build_bars(store, "backwards")
    with pytest.raises(ValueError):
        sinks.save_bars(spark.createDataFrame([], BARS), str(tmp_path / "none"))


def test_upsert_replaces_by_key_and_leaves_other_days_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k long, ddate date, v string"

    def rows(*triples):
        return spark.createDataFrame(list(triples), "k long, d string, v string").select(
            "k", F.to_date("d").alias("ddate"), "v"
        )

    sinks.upsert(rows((1, "2024-01-01", "a"), (2, "2024-01-02", "b")), path, ["k", "ddate"])
    untouched = sorted((tmp_path / "t" / "ddate=2024-01-02").glob("*.parquet"))
    sinks.upsert(rows((1, "2024-01-01", "new"), (3, "2024-01-01", "c")), path, ["k", "ddate"])
    got = spark.read.schema(schema).parquet(path)
    assert rows_of(got, "k", "v") == [(1, "new"), (2, "b"), (3, "c")]
    assert sorted((tmp_path / "t" / "ddate=2024-01-02").glob("*.parquet")) == untouched


def test_result_table_is_replaced_or_refused(spark, tmp_path):
    path = str(tmp_path / "r")
    sinks.save_result(spark.range(3), path)
    sinks.save_result(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.save_result(spark.range(1), path, replace=False)


def test_interval_reads_prune_day_partitions(store, capsys):
    found = tick_ops.ticks_between(store.read("ticks"), DAY, DAY + 3_600_000, [1])
    found.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and "ddate" in plan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(db_tsunx" in plan
    assert {r.ticker_id for r in found.collect()} <= {1}


def test_interval_is_closed_on_both_ends(make_ticks):
    ticks = make_ticks([(1, ms, 1.0) for ms in (999, 1000, 1500, 2000, 2001)])
    assert rows_of(tick_ops.ticks_between(ticks, 1000, 2000), "db_tsunx") == [
        (1000,),
        (1500,),
        (2000,),
    ]


def test_resolved_durations_are_whole_seconds(spark):
    hits = spark.createDataFrame(
        [(1, 10, 1000, 3999), (1, 10, 5000, 3001)],
        "ticker_id long, bar_width_sec int, ts_end long, ts_end_res long",
    ).selectExpr(
        "*", "date'1970-01-01' AS ddate", "1D AS c", "0.1D AS log_oe",
        "date'1970-01-01' AS ddate_res", "1D AS c_res", "'mx' AS res_type",
    )
    assert rows_of(resolved(hits), "dursec_res") == [(-1,), (2,)]


def test_upsert_reads_only_its_days_and_keeps_the_same_row_in_any_order(spark, tmp_path):
    schema = "k long, ddate string, ts long, v string, m map<string,string>"
    rows = [(1, "2024-01-01", 5, "a", {"x": "1"}), (1, "2024-01-01", 7, "b", {}), (2, "2024-01-02", 1, None, None)]
    stored = []
    for i, order in enumerate((rows, rows[::-1])):
        path = str(tmp_path / f"t{i}")
        sinks.upsert(spark.createDataFrame(order, schema), path, ["k", "ddate"])
        stored.append(rows_of(spark.read.schema(schema).parquet(path), "k", "ts", "v"))
    assert stored[0] == stored[1] and (1, 7, "b") in stored[0] and len(stored[0]) == 2
    table = spark.read.schema(schema).parquet(path)
    found = sinks.of_days(table, spark.createDataFrame(rows[2:], schema))
    assert len(found.inputFiles()) >= 1 and rows_of(found, "k") == [(2,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-02" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_second_outcome_run_finds_targets_for_old_bars(store):
    def bar(i, c, low=None):
        values = {
            "ticker_id": 1, "ddate": datetime.date(1970, 1, 1 + i), "bar_width_sec": 30, "ts_begin": i * DAY,
            "ts_end": i * DAY + 30_000, "o": c, "h": c, "l": low or c, "c": c,
        }
        return tuple(values.get(f) for f in BARS.names)

    save = lambda rows: sinks.save_bars(store.spark.createDataFrame(rows, BARS), store.path("bars"))
    save([bar(1, 1.0), bar(2, 1.001), bar(3, 1.0)])
    jobs.build_outcomes(store, [0.02])
    save([bar(4, 1.05, low=1.0)])
    jobs.build_outcomes(store, [0.02], from_last_day=True)
    jobs.build_outcomes(store, [0.02])
    again = rows_of(store.read("bars_fa"), "ts_end", "log_oe", "res_type")
    assert len(again) == 3
    jobs.build_outcomes(store, [0.02], incremental=False)
    assert rows_of(store.read("bars_fa"), "ts_end", "log_oe", "res_type") == again


def test_form_runs_take_back_ends_that_later_outcomes_extend(spark, tmp_path, make_ticks):
    ticks = make_ticks([(1, DAY // 2 + i * 5000, 1.0 + i % 7 / 100, 1.0) for i in range(17_280)])
    day = lambda ms: datetime.date(1970, 1, 1 + ms // DAY)

    def found(at, way="mx", size=0.02):
        values = {"ticker_id": 1, "ddate": day(at), "bar_width_sec": 30, "ts_end": at, "c": 1.0, "log_oe": size, "res_type": way}
        return tuple(values.get(f) for f in OUTCOMES.names)

    # The run that ends the first day goes on after midnight; one end comes in late and splits nothing;
    # one run between others appears late; another threshold is not touched.
    early = [found(DAY - 30_000), found(DAY + 600_000, "mn"), found(DAY - 30_000, "mx", 0.5)]
    late = [found(DAY), found(DAY + 630_000, "mn"), found(DAY + 300_000), found(DAY + 570_000, "mn")]
    stores = [jobs.Store(spark, str(tmp_path / n)) for n in ("runs", "once")]
    for s, parts in zip(stores, ([early, late, late], [early + late]), strict=True):
        jobs.load_ticks(s, ticks)
        for part in parts:
            sinks.save_outcomes(spark.createDataFrame(part, OUTCOMES), s.path("bars_fa"))
            jobs.build_forms(s, [0.02], retract=True)
            if part is early:
                assert rows_of(s.read("bars_forms"), "ts_end") == [(DAY - 30_000,), (DAY + 600_000,)]
    runs, once = (s.read("bars_forms").withColumn("formprops", F.to_json("formprops")) for s in stores)
    assert rows_of(runs, *once.columns) == rows_of(once, *once.columns)
    # The first day has no end any more.
    assert rows_of(runs, "ts_end") == [(DAY,), (DAY + 300_000,), (DAY + 630_000,)]


def test_a_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        jobs.build_bars(jobs.Store(spark, str(tmp_path / "mistyped")))
