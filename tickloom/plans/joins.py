"""Equi-joins of a big table with a smaller one, safe for hot keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import durable

# Broadcast only below this many rows of the small side (counted, not estimated).
SMALL_ROWS = 200_000
# A key with more rows than this on the big side is split over several tasks.
HOT_ROWS = 2_000_000


def fits_broadcast(small: DataFrame, small_rows: int = SMALL_ROWS) -> bool:
    """Count up to the limit; cheap on a written table."""
    return small.limit(small_rows + 1).count() <= small_rows


def hot_keys(big: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    """Keys above the limit with the number of parts each is split into.

    At most |big| / hot_rows rows.
    """
    return (
        big.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(*on, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_parts"))
    )


def split_hot(big, small, on, spread, hot_rows=HOT_ROWS):
    """Give both sides a ``_part`` column so that no key of ``big`` keeps more than about
    ``hot_rows`` rows together.

    Rows of a hot key are dealt out by a hash of ``spread`` (the same on every retry) and the
    matching rows of ``small`` are copied once per part. Other keys stay in part 0.
    """
    hot = durable(hot_keys(big, on, hot_rows), "hot-keys")
    if hot.isEmpty():
        return big.withColumn("_part", F.lit(0)), small.withColumn("_part", F.lit(0))
    if fits_broadcast(hot):
        hot = F.broadcast(hot)
    big = (
        big.join(hot, on, "left")
        .withColumn(
            "_part",
            F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_parts")), F.lit(0)).cast("int"),
        )
        .drop("_parts")
    )
    small = (
        small.join(hot, on, "left")
        .withColumn(
            "_part",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0)))),
        )
        .drop("_parts")
    )
    return big, small


def checked_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    spread: list[str],
    small_rows: int = SMALL_ROWS,
    hot_rows: int = HOT_ROWS,
    at_most: int | None = None,
    big_at_most: int | None = None,
) -> DataFrame:
    """Join where every row of ``big`` is kept on its own (inner, left, left_semi, left_anti).

    ``small`` should be a written table. It is broadcast when its counted size allows that;
    otherwise both sides shuffle, with the hot keys of ``big`` split. ``at_most`` and
    ``big_at_most`` are bounds on the rows of either side that the caller has already established;
    they save the counts.
    """
    fits = at_most <= small_rows if at_most is not None else fits_broadcast(small, small_rows)
    if fits:
        return big.join(F.broadcast(small), on, how)
    if big_at_most is not None and big_at_most <= hot_rows:  # no key can be hot
        return big.join(small, on, how)
    big, small = split_hot(big, small, on, spread, hot_rows)
    return big.join(small, [*on, "_part"], how).drop("_part")
