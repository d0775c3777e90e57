"""Mixing by soft membership.

A naive Bayes classifier over words, fitted to the labelled documents, gives every document the
probabilities of its domains. Document rates r >= 0 are then sought so that the expected tokens per
domain, the sums of rate x tokens x probability, meet the targets: least squares by projected gradient,
started at rates of one. With G the Gram matrix of the memberships, weighted by tokens, and residuals
measured by its inverse, a gradient step of length one is the projection onto the rates that meet the
targets, and the step back to r >= 0 the projection onto the orthant; the two alternate, with
momentum, until the targets hold. Targets out of reach are approached by weighing single memberships. Each step is one distributed sum of as many numbers as there are domains.
DataFrame functions only.
"""

import itertools
import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

DOMAINS = ("high", "low", "toxic")
# Shares of the tokens that the mix is to have, and its tokens relative to the corpus.
TARGETS, SIZE = (0.90, 0.09, 0.01), 1.0
# The classifier is fitted to at most so many labelled documents, picked by a hash of their id.
FIT_ROWS = 20_000
# Words share so many buckets; so many of them, the most telling ones, are features.
BUCKETS, FEATURES = 1 << 16, 512
STEPS, CLOSE = 60, 1e-7
# While the steps are sought, the numbers they sum are written after so many of them.
SPAN = 8
# Rows at most that are weighed against the mix where steps alone do not meet the targets.
CORRECTIONS = 12


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _traits(text: Column) -> Column:
    """A few marks of the whole text, as words that no text holds."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    marks = F.regexp_count(text, F.lit(r"[!|#*$%&<>]")) / size
    capitals = F.regexp_count(text, F.lit(r"\p{Lu}")) / size
    lines = F.split(text, "\n")
    repeats = 1 - F.size(F.array_distinct(lines)) / F.size(lines)
    words = words_of(text)
    heads = F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))

    def step(name, x, at):
        return F.concat(F.lit(f"\n{name}"), sum((F.when(x > a, 1).otherwise(0) for a in at), F.lit(0)))

    return F.array(
        step("marks", marks, (0.01, 0.05)),
        step("capitals", capitals, (0.1, 0.3)),
        step("repeats", repeats, (0.1, 0.5)),
        step("heads", heads, (0.1, 0.3)),
    )


def buckets_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def domain_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain number) of labelled rows; several labels of a document count as the worst."""
    worst = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)
    rows = labels.select("doc_id", worst.alias("domain")).where("doc_id is not null and domain is not null")
    return rows.groupBy("doc_id").agg(F.max("domain").alias("domain"))


def fitted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """Naive Bayes over the presence of the FEATURES buckets with the most information about the
    domain. Nothing labelled: every domain is as likely for every document."""
    picked = domain_of(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(written(picked, "labelled")), "doc_id")
    rows = written(
        rows.select(
            "domain",
            F.array_distinct(
                buckets_of(F.concat(words_of(F.col("text")), _traits(F.col("text"))))
            ).alias("buckets"),
        ),
        "labelled-buckets",
    )
    sizes = {r[0]: r[1] for r in rows.groupBy("domain").count().collect()}
    n = [sizes.get(k, 0) for k in range(len(DOMAINS))]
    total = sum(n)
    prior = [math.log((x + 1) / (total + len(n))) for x in n]
    if total == 0:
        return {"prior": prior, "bucket": [], "logit": []}
    counts = rows.select("domain", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        *(F.sum((F.col("domain") == k).cast("long")).alias(f"n{k}") for k in range(len(n)))
    )
    gain = F.lit(0.0)
    seen = sum((F.col(f"n{k}") for k in range(len(n))), F.lit(0))
    for k in range(len(n)):
        for here, all_here in (
            (F.col(f"n{k}") + 0.5, seen + 1),
            (n[k] - F.col(f"n{k}") + 0.5, total - seen + 1),
        ):
            gain = gain + here / total * F.log(here * total / (all_here * (n[k] + 0.5)))
    best = counts.orderBy(F.desc(gain), "bucket").limit(FEATURES).collect()
    share = np.array([[(r[f"n{k}"] + 0.5) / (n[k] + 1) for k in range(len(n))] for r in best])
    prior = np.array(prior) + np.log1p(-share).sum(axis=0)
    logit = np.log(share) - np.log1p(-share)
    return {"prior": prior.tolist(), "bucket": [r["bucket"] for r in best], "logit": logit.tolist()}


def _numbers(values, kind: str) -> Column:
    """An array of constants, folded once when the query is planned."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def posteriors(docs: DataFrame, model: dict, keep=("doc_id",)) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``) with n_tokens (words) and p_<domain>, which add up to one."""
    feature = np.full(BUCKETS, -1)
    feature[np.array(model["bucket"], int)] = np.arange(len(model["bucket"]))
    at = _numbers(feature, "int")
    words = docs.select(*keep, words_of(F.col("text")).alias("_words"), _traits(F.col("text")).alias("_traits"))
    found = F.filter(
        F.transform(buckets_of(F.concat("_words", "_traits")), lambda b: F.get(at, b)), lambda f: f >= 0
    )
    rows = words.select(*keep, F.size("_words").cast("long").alias("n_tokens"), F.array_distinct(found).alias("_f"))

    def log_odds(k):
        weights = _numbers([x[k] for x in model["logit"]] or [0.0], "double")
        return F.aggregate("_f", F.lit(float(model["prior"][k])), lambda s, f: s + F.get(weights, f))

    rows = rows.select(*keep, "n_tokens", *(log_odds(k).alias(f"_s{k}") for k in range(len(DOMAINS))))
    top = F.greatest(*(F.col(f"_s{k}") for k in range(len(DOMAINS))))
    rows = rows.select(*keep, "n_tokens", *(F.exp(F.col(f"_s{k}") - top).alias(f"_e{k}") for k in range(len(DOMAINS))))
    whole = sum((F.col(f"_e{k}") for k in range(1, len(DOMAINS))), F.col("_e0"))
    return rows.select(
        *keep, "n_tokens", *((F.col(f"_e{k}") / whole).alias(f"p_{name}") for k, name in enumerate(DOMAINS))
    )


def _nonnegative(columns: np.ndarray, goal: np.ndarray, metric: np.ndarray) -> np.ndarray:
    """Least squares with nonnegative weights of a few columns, by trying every set that can be it."""
    best, weights = math.inf, np.zeros(columns.shape[1])
    for size in range(1, len(goal) + 1):
        for some in map(list, itertools.combinations(range(columns.shape[1]), size)):
            part = columns[:, some]
            x = np.linalg.lstsq(part.T @ metric @ part, part.T @ metric @ goal, rcond=None)[0]
            left = part @ x - goal
            if (x >= 0).all() and left @ metric @ left < best:
                best, weights = left @ metric @ left, np.zeros(columns.shape[1])
                weights[some] = x
    return weights


def rated(rows: DataFrame, targets, steps: int = STEPS, close: float = CLOSE) -> DataFrame:
    """Add ``rate`` to rows with n_tokens and p_<domain>, for ``targets`` in tokens per domain.

    At most ``steps`` projected gradient steps are taken. If the targets are not met by then they may
    be out of reach, where such steps end slowly: the rows whose weight would help most, found one
    after the other, are then weighed against the mix so far, up to ``CORRECTIONS`` times. What is left
    after that is told in a warning. A domain that nothing belongs to is left alone; so is everything
    without tokens (rate one).
    """
    names = [f"p_{d}" for d in DOMAINS]
    n = F.col("n_tokens").cast("double")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    first = rows.agg(
        *(F.coalesce(F.sum(n * F.col(names[i]) * F.col(names[j])), F.lit(0.0)) for i, j in pairs)
    ).first()
    gram = np.zeros((len(names), len(names)))
    for (i, j), x in zip(pairs, first, strict=True):
        gram[i, j] = gram[j, i] = x
    inverse = np.linalg.pinv(gram, rcond=1e-10, hermitian=True)
    goal = np.array(targets, float)
    near = close * max(1.0, goal.sum())
    # The sums need neither ids nor other columns, so only these numbers are written between steps.
    slim = rows.select("n_tokens", *names, F.lit(1.0).alias("rate"), F.lit(1.0).alias("_before"))
    taken: list[tuple] = []

    def totals(rate) -> np.ndarray:
        return np.array(slim.agg(*(F.coalesce(F.sum(n * rate * F.col(p)), F.lit(0.0)) for p in names)).first())

    def take(*step):
        nonlocal slim
        taken.append(tuple(map(float, step)))
        rate = _moved(F.col("rate"), F.col("_before"), [F.lit(x) for x in taken[-1]])
        slim = slim.withColumns({"rate": rate, "_before": F.col("rate")})
        if len(taken) % SPAN == 0:
            slim = written(slim, "rates")

    still = [0.0] * len(names)
    before, error, speed = None, math.inf, 0
    for _ in range(steps):
        total = totals(F.col("rate"))
        left = total - goal
        if np.abs(left).max() <= near:
            return _replayed(rows, taken)
        speed = speed + 1 if left @ inverse @ left <= error else 0  # momentum, dropped when it hurts
        error = left @ inverse @ left
        push = (speed - 1) / (speed + 2) if speed > 1 and before is not None else 0.0
        move = inverse @ (left + push * (total - (before if before is not None else total)))
        before = total
        take(push, *move, 1.0, *still, 0.0)
    best: dict[tuple, np.ndarray] = {}
    for _ in range(CORRECTIONS):
        total = totals(F.col("rate"))
        left = total - goal
        error = left @ inverse @ left
        if np.abs(left).max() <= near:
            return _replayed(rows, taken)
        slope = sum((F.col(p) * float(x) for p, x in zip(names, inverse @ left, strict=True)), F.lit(0.0))
        helpful = slim.where("n_tokens > 0").agg(F.min_by(F.struct(*names), slope)).first()[0]
        if helpful is None:
            break
        same = F.lit(True)
        for p in names:
            same &= F.col(p) == helpful[p]
        weight = slim.where(same).agg(F.sum(n)).first()[0]
        best.pop(tuple(helpful), None)
        best = dict([*best.items()][-2:]) | {tuple(helpful): weight * np.array(helpful)}
        mix = _nonnegative(np.column_stack([total, *best.values()]), goal, inverse)
        after = np.column_stack([total, *best.values()]) @ mix - goal
        if after @ inverse @ after >= error * (1 - 1e-9):
            break
        for k, (vector, x) in enumerate(zip(best, mix[1:], strict=True)):
            take(0.0, *still, mix[0] if k == 0 else 1.0, *vector, x)
    left = totals(F.col("rate")) - goal
    if np.abs(left).max() > near:
        off = ", ".join(f"{d} {x:+.0f}" for d, x in zip(DOMAINS, left, strict=True))
        warnings.warn(f"targets not met, off by (tokens) {off}", stacklevel=2)
    return _replayed(rows, taken)


def _moved(rate, before, step) -> Column:
    """The rate after one step from (rate, before): push, a move per domain, then a factor, the
    memberships of the rows to add to and how much. Rows without tokens keep theirs."""
    push, *rest = step
    k = len(DOMAINS)
    moves, factor, vector, more = rest[:k], rest[k], rest[k + 1 : 2 * k + 1], rest[2 * k + 1]
    shift = sum((F.col(f"p_{d}") * m for d, m in zip(DOMAINS, moves, strict=True)), F.lit(0.0))
    new = factor * F.greatest(F.lit(0.0), rate + push * (rate - before) - shift)
    same = more > 0
    for d, x in zip(DOMAINS, vector, strict=True):
        same &= F.col(f"p_{d}") == x
    return F.when(F.col("n_tokens") > 0, new + F.when(same, more).otherwise(0.0)).otherwise(rate)


def _replayed(rows: DataFrame, taken: list[tuple]) -> DataFrame:
    """Add ``rate``: all steps taken, folded over each row."""
    if not taken:
        return rows.withColumn("rate", F.lit(1.0))
    width = len(taken[0])
    steps = F.arrays_zip(
        *(_numbers(column, "double").alias(f"s{k}") for k, column in enumerate(zip(*taken, strict=True)))
    )

    def fold(state, step):
        new = _moved(state["rate"], state["before"], [step[f"s{k}"] for k in range(width)])
        return F.struct(new.alias("rate"), state["rate"].alias("before"))

    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("before"))
    return rows.withColumn("rate", F.aggregate(steps, start, fold, lambda state: state["rate"]))


def mixed(
    docs: DataFrame, labels: DataFrame, shares=TARGETS, size: float = SIZE, keep=("doc_id",),
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``) with n_tokens, p_<domain> and rate.

    ``shares`` are the target weights of DOMAINS, ``size`` the tokens of the mix relative to those
    of ``docs``. Null and empty texts have no tokens and rate one. Labels of unknown documents and
    null labels are passed over. Repeated rows each get their rate; an empty table an empty result.
    """
    model = fitted(docs, labels, fit_rows)
    rows = written(posteriors(docs, model, keep), "posteriors")
    total = rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    return rated(rows, [total * size * x for x in shares])


def copies(rate: Column, *ids) -> Column:
    """Whole copies for a rate: its integer part, and one more with the chance of the rest, drawn by
    a hash of the columns ``ids``."""
    draw = F.pmod(F.xxhash64(*ids, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")
