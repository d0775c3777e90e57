"""Exact shares of a table by the hash of a key.

The same rows fall into the same parts however the table is stored, partitioned or read again, and rows
with equal keys stay together.
"""

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hex digits of the hash whose counts the driver sees: 65,536 numbers at most.
PREFIX = 4


def key_hash(key: list[str], seed: int) -> Column:
    """Hex hash of the key's values as text, joined by bars after the seed; a null counts as empty."""
    values = (F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key)
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *values))


def split(df: DataFrame, weights: list[float], key: list[str], seed: int) -> list[DataFrame]:
    """Parts whose row numbers are the weights' shares, rounded half up; only rows with the key at a
    border can make a part smaller.

    Rows are not moved: one pass counts hashes by prefix, one sorted prefix per border gives the hash
    there, and the parts are filters. An empty table gives empty parts.
    """
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError(f"not weights: {weights!r}")
    value = key_hash(key, seed)
    prefix = F.substring(value, 1, PREFIX)
    counts = sorted(df.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1))).collect())
    total = sum(n for _, n in counts)

    def hash_at(place: int) -> str:
        for start, n in counts:
            if place < n:
                inside = df.select(value.alias("hash")).where(F.col("hash").startswith(start))
                return inside.orderBy("hash").offset(place).limit(1).first()[0]
            place -= n
        return "g"  # behind every hex digit

    ends = [int(total * w / sum(weights) + 0.5) for w in accumulate(weights[:-1])]
    borders = ["", *map(hash_at, ends), "g"]
    return [df.where((value >= a) & (value < b)) for a, b in zip(borders, borders[1:], strict=False)]
