"""Unix-millisecond and UTC-day helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_day(ms: Column) -> Column:
    """UTC calendar day of a unix-millisecond value (session time zone is UTC)."""
    return F.to_date(F.timestamp_millis(ms))


def whole_seconds(ms: Column) -> Column:
    """Milliseconds to seconds, truncated towards zero as integer division does."""
    return F.when(ms >= 0, F.floor(ms / F.lit(1000))).otherwise(F.ceil(ms / F.lit(1000)))
