"""Writes: keyed upserts, appends, whole-table overwrites."""

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bars import bars_dates_summary
from ..operators.daysummary import day_summary
from ..plans.days import of_days
from ..plans.durable import durable
from ..schema import BARS_DATES, KEYS, OPEN_RUNS, OPEN_SEARCHES, PENDING_DAYS, TICKS, TICKS_DAYS


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _write_days(rows: DataFrame, path: str, mode: str, **options) -> None:
    # REBALANCE gives each day few files and still splits a day that holds most of the rows.
    (
        rows.hint("rebalance", "ddate")
        .write.mode(mode)
        .options(**options)
        .partitionBy("ddate")
        .parquet(path)
    )


def one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with equal keys the one with the greatest other columns, compared from left to right,
    whatever order the rows come in."""
    others = [f for f in rows.schema if f.name not in keys]
    if not others:
        return rows.dropDuplicates(keys)
    order = F.struct(
        *(
            F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name)
            for f in others
        )
    )
    best = F.max_by(F.struct(*(f.name for f in others)), order).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*rows.columns)


def upsert(rows: DataFrame, path: str, keys: list[str], gone: DataFrame | None = None) -> None:
    """Insert rows, replacing stored rows with the same key; stored rows with a key of ``gone`` go.

    Only the day partitions that the keys name are read and rewritten. The new days replace the old
    ones when the job commits; a job that fails before that leaves the table as it was. Days of
    ``gone`` that are left without rows are emptied after that, so a save that ends in between is to
    be repeated.
    """
    fresh = durable(one_per_key(rows, keys), "upsert")
    stored = read_or_empty(rows.sparkSession, path, rows.schema)
    named = fresh.select(*keys)
    if gone is not None:
        gone = durable(gone.select(*keys).distinct(), "gone")
        named = named.unionByName(gone)
    kept = of_days(stored, named).join(named, keys, "left_anti")
    days = kept.unionByName(fresh.select(*kept.columns))
    emptied = []
    if gone is not None:
        lost = gone.select("ddate").distinct().join(days.select("ddate").distinct(), "ddate", "left_anti")
        emptied = [r[0] for r in lost.where("ddate is not null").collect()]  # calendar days
    _write_days(days, path, "overwrite", partitionOverwriteMode="dynamic")
    for day in emptied:
        fresh.limit(0).drop("ddate").write.mode("overwrite").parquet(f"{path}/ddate={day}")


def save_ticks(ticks: DataFrame, path: str) -> None:
    upsert(ticks, path, KEYS["ticks"])


def load_ticks(ticks: DataFrame, path: str, days_path: str, pending_path: str) -> None:
    """Upsert ticks and bring the day summary up to date, for the days of ``ticks`` only.

    The days are noted as pending before the ticks change and taken off after the summary has; a load
    that ends in between leaves them noted, and readers work those days out from the ticks.
    """
    days = durable(ticks.select("ddate").distinct(), "touched-days")
    days.write.mode("append").parquet(pending_path)
    save_ticks(ticks, path)
    refresh_days(days, path, days_path, pending_path)


def refresh_days(days: DataFrame, path: str, days_path: str, pending_path: str) -> None:
    """Rebuild the day summary of ``days`` and of all pending days from the stored ticks."""
    spark = days.sparkSession
    noted = read_or_empty(spark, pending_path, PENDING_DAYS)
    touched = durable(noted.union(days.select("ddate")).distinct(), "pending-days")
    stored = of_days(read_or_empty(spark, path, TICKS), touched)
    summary = day_summary(stored).select(*TICKS_DAYS.names)
    _write_days(summary, days_path, "overwrite", partitionOverwriteMode="dynamic")
    touched.limit(0).write.mode("overwrite").parquet(pending_path)


def tick_days(spark: SparkSession, path: str, days_path: str, pending_path: str) -> DataFrame:
    """The stored day summary; pending days, and all days where no summary was ever written, are
    worked out from the ticks."""
    ticks = read_or_empty(spark, path, TICKS)
    stored = read_or_empty(spark, days_path, TICKS_DAYS)
    if stored.isEmpty():
        return day_summary(ticks).select(*TICKS_DAYS.names)
    pending = read_or_empty(spark, pending_path, PENDING_DAYS)
    if pending.isEmpty():
        return stored
    listed = pending.distinct()
    fresh = day_summary(of_days(ticks, listed)).select(*TICKS_DAYS.names)
    return stored.join(listed, "ddate", "left_anti").select(*TICKS_DAYS.names).unionByName(fresh)


def save_bars(bars: DataFrame, path: str, dates_path: str | None = None) -> None:
    """Upsert bars and append one summary row per series and day of this save.

    The summary comes first: a save that ends in between names days whose bars are still missing, which
    readers of the summary then look at in vain, but never leaves bars that no summary names.
    """
    if bars.isEmpty():
        raise ValueError("no bars to save")
    if dates_path:
        stamp = F.lit(int(time.time() * 1000))
        summary = bars_dates_summary(bars).withColumn("curr_ts", stamp)
        summary.select(*BARS_DATES.names).write.mode("append").parquet(dates_path)
    upsert(bars, path, KEYS["bars"])


def save_outcomes(outcomes: DataFrame, path: str) -> None:
    upsert(outcomes, path, KEYS["bars_fa"])


def save_open(searches: DataFrame, path: str, runs_path: str) -> None:
    """Replace the open searches. The rows of a run go to one of two slots and count once the run is
    noted; a save that ends before that leaves the rows of the run before, in the other slot."""
    spark = searches.sparkSession
    run = _last_run(spark, runs_path) + 1
    (
        searches.withColumns({"run": F.lit(run).cast("long"), "slot": F.lit(run % 2)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("slot")
        .parquet(path)
    )
    spark.createDataFrame([(run,)], OPEN_RUNS).coalesce(1).write.mode("append").parquet(runs_path)


def _last_run(spark: SparkSession, runs_path: str) -> int:
    return read_or_empty(spark, runs_path, OPEN_RUNS).agg(F.max("run")).first()[0] or 0


def open_searches(spark: SparkSession, path: str, runs_path: str) -> DataFrame:
    """The open searches of the last noted run; none before the first."""
    run = _last_run(spark, runs_path)
    rows = T.StructType([*OPEN_SEARCHES, *OPEN_RUNS, T.StructField("slot", T.IntegerType())])
    stored = read_or_empty(spark, path, rows)
    # An empty run leaves the rows of an older one in its slot.
    return stored.where((F.col("slot") == run % 2) & (F.col("run") == run)).drop("slot", "run")


def save_forms(forms: DataFrame, path: str, gone: DataFrame | None = None) -> None:
    upsert(forms, path, KEYS["bars_forms"], gone)


def save_result(result: DataFrame, path: str, replace: bool = True) -> None:
    """The scored table: replaced as a whole, or refused when it already exists."""
    result.write.mode("overwrite" if replace else "errorifexists").parquet(path)


def publish(df: DataFrame, name: str) -> None:
    """Share a table with every session of the application as ``global_temp.<name>``."""
    df.createOrReplaceGlobalTempView(name)
