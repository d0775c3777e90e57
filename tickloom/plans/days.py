"""Reads of only some day partitions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to so many days (55 years) are stated as values.
MOST_DAYS = 20_000


def of_days(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored rows of the days of ``rows``. The days are stated as values, so that other day
    partitions are not read; more days than a calendar holds are joined instead."""
    days = rows.select("ddate").where("ddate is not null").distinct()
    listed = [r[0] for r in days.limit(MOST_DAYS + 1).collect()]
    if len(listed) > MOST_DAYS:
        return stored.join(days, "ddate", "left_semi")
    return stored.where(F.col("ddate").isin(listed))
