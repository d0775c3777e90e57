"""Quality rules with adaptive thresholds.

Per document a few measures are taken from its words and lines. Their quantiles are summarised per
(lang, source) by Spark's mergeable quantile summary (partial summaries per task, merged after the
shuffle), and the limits of a group are set from its own quartiles. The limits, one row per group,
are joined back and decide. DataFrame functions only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import fits_broadcast
from .common import written

# Base rule.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
# A limit lies this many interquartile ranges above the upper quartile of its group...
FENCE = 6.0
# ...and never below the floor of its measure, so that a very even group rejects nothing by noise.
FLOORS = {"symbol_share": 0.05, "dup_line_share": 0.3, "repeat_share": 0.1, "mean_word": 20.0}
# Rank error of the quantile summaries is 1 / ACCURACY of a group's documents.
ACCURACY = 10_000
# Windows of so many words are looked at for repeats.
WINDOW = 5

_SEPARATORS = r"[\x20\x09-\x0D]+"
# Positions take the low bits of a packed (window hash, position).
_BITS = 24


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _positions_repeated(hashes: Column) -> Column:
    """Ascending positions whose window hash occurs at least twice."""
    low = (1 << _BITS) - 1

    def marked(order, key, position):
        def beside(x, i):
            before = F.when(i > 0, F.get(order, i - 1))
            return (key(x) == key(F.get(order, i + 1))) | (key(x) == key(before))

        return F.array_sort(F.transform(F.filter(order, beside), position))

    def packed(h, i):
        return h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))

    fits = (
        F.size(F.array_distinct(F.transform(hashes, lambda h: F.shiftright(h, _BITS))))
        == F.size(F.array_distinct(hashes))
    ) & (F.size(hashes) <= low)
    return F.when(
        fits,
        _let(
            F.sort_array(F.transform(hashes, packed)),
            lambda order: marked(
                order,
                lambda x: F.shiftright(x, _BITS),
                lambda x: x.bitwiseAND(F.lit(low)).cast("int"),
            ),
        ),
    ).otherwise(
        _let(
            F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            lambda order: marked(order, lambda x: x["h"], lambda x: x["i"]),
        )
    )


def _covered(positions: Column, width: int) -> Column:
    """How many words the windows at these ascending positions cover."""
    return F.aggregate(
        positions,
        F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last")),
        lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(width), p - a["last"])).alias("n"), p.alias("last")
        ),
        lambda a: a["n"].cast("long"),
    )


def measured(docs: DataFrame, keep=("doc_id", "lang", "source")) -> DataFrame:
    """The base counts of every whole text: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words. Null and empty texts have no words."""
    columns = [F.col(c) for c in keep]
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, _SEPARATORS), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    wide = docs.select(
        *columns,
        words.alias("_words"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    count = F.size("_words")
    hashes = F.when(
        count >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.greatest(count - (WINDOW - 1), F.lit(1))),
            lambda i: F.xxhash64(F.slice("_words", i, WINDOW)),
        ),
    ).otherwise(F.expr("cast(array() as array<bigint>)"))
    wide = wide.select(
        *keep,
        count.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        hashes.alias("_hashes"),
    )
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    return wide.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(repeated, _covered(_positions_repeated(F.col("_hashes")), WINDOW))
        .otherwise(F.lit(0).cast("long"))
        .alias("n_repeat_words"),
    )


def shares(counts: DataFrame) -> dict[str, Column]:
    """The measures that have limits, each a double; null without words."""
    n = F.nullif(F.col("n_words"), F.lit(0))
    return {
        "symbol_share": F.col("n_symbols") / F.nullif(F.col("word_chars"), F.lit(0)),
        "dup_line_share": F.col("n_dup_lines") / n,
        "repeat_share": F.col("n_repeat_words") / n,
        "mean_word": F.col("word_chars") / n,
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def limits(counts: DataFrame, groups=("lang", "source"), fence=FENCE, accuracy=ACCURACY):
    """One row per group with an upper limit for each measure, from the group's documents that
    pass the base rule. Groups with null keys are groups like others."""
    kinds = shares(counts)
    quartiles = [
        F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.75)), accuracy).alias(name)
        for name, x in kinds.items()
    ]
    grouped = counts.where(~base_failed()).groupBy(*groups).agg(*quartiles)
    return grouped.select(
        *(F.col(g).alias(f"_{g}") for g in groups),
        *(
            F.greatest(
                F.lit(FLOORS[name]), F.col(name)[1] + fence * (F.col(name)[1] - F.col(name)[0])
            ).alias(f"max_{name}")
            for name in kinds
        ),
    )


def judged(docs: DataFrame, groups=("lang", "source"), fence=FENCE, accuracy=ACCURACY):
    """Every row of ``docs`` with its base counts, base_failed and kept.

    Kept: passes the base rule and no measure is above the limit of the document's (lang, source)
    group. A null lang or source forms a group of its own. Repeated rows each get their verdict. An
    empty table gives an empty result. Extra columns of ``docs`` are left out.
    """
    counts = written(measured(docs, ("doc_id", *groups)), "measured")
    bounds = written(limits(counts, groups, fence, accuracy), "limits")
    on = None
    for g in groups:
        same = F.col(g).eqNullSafe(F.col(f"_{g}"))
        on = same if on is None else on & same
    if fits_broadcast(bounds):
        bounds = F.broadcast(bounds)
    kinds = shares(counts)
    over = F.lit(False)
    for name, x in kinds.items():
        over = over | F.coalesce(x > F.col(f"max_{name}"), F.lit(False))
    return counts.join(bounds, on, "left").select(
        *counts.columns, base_failed().alias("base_failed"), (~base_failed() & ~over).alias("kept")
    )
