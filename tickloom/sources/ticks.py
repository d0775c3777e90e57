"""Tick reads: the event-table mapping and the three interval scans."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import utc_day
from ..plans.durable import durable
from ..plans.joins import checked_join
from ..schema import TICKS

# Instrument code of each event type (alphabetical).
EVENT_CODES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    """Ticks stored as Parquet partitioned by ``ddate``."""
    return spark.read.schema(TICKS).parquet(path)


def ticks_from_events(events: DataFrame, mapping: str = "sparse") -> DataFrame:
    """Event rows as ticks: ``sparse`` is one instrument per user, ``dense`` one per type."""
    if mapping == "sparse":
        ticker = F.col("user_id")
    else:
        ticker = F.coalesce(
            *(F.when(F.col("event_type") == name, code) for name, code in EVENT_CODES.items())
        )
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        ticker.cast("long").alias("ticker_id"),
        F.col("ts").cast("date").alias("ddate"),
        ms.alias("ts"),
        ms.alias("db_tsunx"),
        (F.col("value") + F.lit(0.02)).alias("ask"),
        F.col("value").alias("bid"),
    )


def _in_interval(begin_ms: Column, end_ms: Column) -> Column:
    # The day bounds follow from the millisecond bounds; stating them prunes partitions.
    return F.col("ddate").between(utc_day(begin_ms), utc_day(end_ms)) & F.col(
        "db_tsunx"
    ).between(begin_ms, end_ms)


def ticks_between(
    ticks: DataFrame, begin_ms: int, end_ms: int, ticker_ids: list[int] | None = None
) -> DataFrame:
    """Ticks with ``begin <= db_tsunx <= end``, for all instruments or a few."""
    found = ticks.where(_in_interval(F.lit(begin_ms), F.lit(end_ms)))
    if ticker_ids is not None:
        found = found.where(F.col("ticker_id").isin(*ticker_ids))
    return found.orderBy("ticker_id", "ts", "db_tsunx")


def ticks_for_bars(ticks: DataFrame, bars: DataFrame) -> DataFrame:
    """Ticks of each instrument between its first and its last given bar end, both included,
    on the days those bars carry."""
    spans = durable(_spans(bars), "bar-spans")
    return (
        checked_join(ticks, spans, ["ticker_id"], spread=["db_tsunx", "ts"])
        .where(
            F.col("db_tsunx").between(F.col("_from"), F.col("_to"))
            & F.col("ddate").between(F.col("_day_from"), F.col("_day_to"))
        )
        .select(*ticks.columns)
        .orderBy("ticker_id", "db_tsunx", "ts")
    )


def _spans(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker_id").agg(
        F.min("ts_end").alias("_from"),
        F.max("ts_end").alias("_to"),
        F.min("ddate").alias("_day_from"),
        F.max("ddate").alias("_day_to"),
    )


def ticks_for_form(
    ticks: DataFrame, begin_ms: int, end_ms: int, last_day, ticker_ids: list[int] | None = None
) -> DataFrame:
    """Ticks of a form's closed interval, but of no day after ``last_day``."""
    return ticks_between(ticks, begin_ms, end_ms, ticker_ids).where(
        F.col("ddate") <= F.lit(last_day).cast("date")
    )
