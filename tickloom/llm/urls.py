"""URL filter: path rules first, then a list of host keys held in a cascade of Bloom filters.

The first level encodes the listed keys. Over the complete key universe of the corpus some keys that
are not listed pass it; the second level encodes those. Some listed keys pass the second level; the
third encodes those; and so on until no wrong key is left. A key's membership is then exact for every
key of the universe and takes a few bit tests in the scan: no join, no list. DataFrame functions only.
"""

import dataclasses
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

BITS_PER_KEY, HASHES = 10, 7
# A level has at most so many bits (1 MB, over 800,000 keys); longer lists are cut into shards by a
# hash of the key, with a cascade each, and the urls are judged shard by shard.
MOST_BITS = 1 << 23

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def host_keys(host: Column) -> Column:
    """The host and all domains above it; none for an empty host."""
    labels = F.split(host, r"\.")
    keys = F.transform(
        labels,
        lambda _, i: F.array_join(F.slice(labels, i + 1, F.greatest(F.size(labels) - i, F.lit(0))), "."),
    )
    return F.filter(keys, lambda k: k != "")


def first_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null without one. A rule ``host/path`` fits its
    host and all subdomains where the url's path starts with the rule's."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, said in sorted(rules, key=lambda x: len(x[0])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{rest}")
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


@dataclasses.dataclass
class Level:
    number: int
    bits: int
    words: str

    def holds(self, key: Column) -> Column:
        """Whether all bits of the key are set."""
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")
        places = F.transform(F.array(*(F.lit(j) for j in range(HASHES))), lambda j: self.place(key, j))
        return F.forall(
            places,
            lambda p: F.bit_get(
                F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")
            ) == 1,
        )

    def place(self, key: Column, j: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.number), j), F.lit(self.bits).cast("bigint"))


def _level(number: int, keys: DataFrame, n: int) -> Level:
    """Bloom filter of the n distinct ``keys``: set bits are merged word by word."""
    bits = max(64, math.ceil(n * BITS_PER_KEY / 64) * 64)
    level = Level(number, bits, "")
    place = keys.select(
        F.explode(F.transform(F.array(*(F.lit(j) for j in range(HASHES))),
                              lambda j: level.place(F.col("key"), j))).alias("p")
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(63).cast("int"))
    words = place.select(F.shiftright("p", 6).alias("w"), bit.alias("b"))
    words = words.groupBy("w").agg(F.bit_or("b").alias("b"))
    held = {r["w"]: r["b"] for r in words.collect()}  # at most MOST_BITS / 64 rows
    level.words = ",".join(str(held.get(i, 0)) for i in range(bits // 64))
    return level


def cascade(universe: DataFrame) -> list[Level]:
    """Levels for the distinct keys ``universe`` (key, listed)."""
    levels: list[Level] = []
    inside, outside = universe.where("listed").select("key"), universe.where("not listed").select("key")
    while (n := inside.count()) > 0:
        levels.append(_level(len(levels), inside, n))
        wrong = written(outside.where(levels[-1].holds(F.col("key"))), f"wrong-{len(levels)}")
        inside, outside = wrong, inside
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Exact membership of a key of the universe."""
    found = F.lit(False)
    for level in reversed(levels):
        found = level.holds(key) & ~found
    return found


def shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(shards))


def judged(
    pages: DataFrame, listed: Column, rules: list[tuple[str, str]], keep=("page_id",), most_bits=MOST_BITS
) -> DataFrame:
    """Every row of ``pages`` with host, path, rule and verdict (allow or block).

    ``listed`` says of a column ``key`` (a host or a domain above one) whether it is on the list. A
    url is blocked by the longest fitting rule or, without one, if a key of its host is listed.
    Null urls and urls without :// have an empty host and path, no rule, and are allowed. Repeated
    rows each get their verdict, an empty table gives an empty result; extra columns are left out.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(*keep, host.alias("host"), path.alias("path"))
    keys = rows.select("host").distinct().select(F.explode(host_keys(F.col("host"))).alias("key"))
    universe = written(keys.distinct().withColumn("listed", F.coalesce(listed, F.lit(False))), "keys")
    n = universe.where("listed").count()
    shards = max(1, math.ceil(2 * n * BITS_PER_KEY / most_bits))
    rows = rows.withColumn("_listed", F.lit(False))
    for s in range(shards):
        levels = cascade(universe.where(shard(F.col("key"), shards) == s))
        one = F.exists(
            host_keys(F.col("host")), _within(levels, shards, s)
        )
        rows = rows.withColumn("_listed", F.col("_listed") | one)
        if shards > 1:
            rows = written(rows, "judged")
    rule, said = first_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        *keep, "host", "path", rule.alias("rule"), F.coalesce(said, own).alias("verdict")
    )


def _within(levels: list[Level], shards: int, number: int):
    return lambda key: (shard(key, shards) == number) & member(levels, key)
