"""Language identification by interpolated Kneser-Ney models of characters, one per language.

Texts are read as letters in lower case with one space for anything between them. Spark counts the
n-grams of all training texts and works out the Kneser-Ney estimates with grouped sums and joins.
Scoring needs hash arrays per language and order: sorted hashes of n-grams with their log
probability, and of contexts with the log weight they leave to the lower order. The language of the
lowest cross-entropy per character wins. One fold of the training documents is left out of the
counts; it sets the limits of rejection and the scale of the score.
"""

import dataclasses
import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat, per_text, pieces, small_batches, written
from .words import mix

ORDER = 4
# Symbols take so many bits; letters beyond Latin share the upper symbols by a hash.
SYMBOL_BITS, LATIN = 9, 384
# n-grams of one language and order are stored by hashes of so many bits, which bounds every array.
HASH_BITS = 21
MOST_LANGUAGES = 500
# A document is rejected this many deviations above the mean cross-entropy of its language, and at
# least so many nats per symbol, which texts with a passage in another language stay below.
TOLERANCE, LEAST_EXCESS = 8.0, 1.0
# Scales of the score that are tried on the calibration fold.
SCALES = (0.5, 1.0, 2.0, 4.0, 8.0)
PIECE = 2 << 20
_MASK = (1 << SYMBOL_BITS) - 1


@functools.lru_cache(1)
def _symbols() -> np.ndarray:
    """Symbol of every code point: 0 for all but letters."""
    shared = (1 << SYMBOL_BITS) - LATIN

    def of(code):
        letter = chr(code)
        if not letter.isalpha():
            return 0
        low = letter.lower()
        code = ord(low) if len(low) == 1 else code
        return code if code < LATIN else LATIN + code * 40503 % shared

    return np.fromiter(map(of, range(0x110000)), np.uint16, 0x110000)


def sequence(texts: pa.Array):
    """(text number, n-gram of ORDER symbols) for every symbol of all texts, spaces included.

    A text begins after spaces and ends with one; a text without letters has no symbols.
    """
    listed = texts.to_pylist()
    codes = np.frombuffer(("\n".join(listed) + "\n").encode("utf-32-le"), np.uint32)
    symbol = _symbols()[codes]
    kept = symbol != 0
    kept[1:] |= symbol[:-1] != 0  # the first of the spaces after a letter
    owner = np.repeat(
        np.arange(len(listed)), np.fromiter(map(len, listed), np.int64, len(listed)) + 1
    )
    owner, symbol = owner[kept], symbol[kept].astype(np.int64)
    begins = np.ones(len(owner), bool)
    begins[1:] = owner[1:] != owner[:-1]
    start = np.flatnonzero(begins)
    position = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
    gram = symbol.copy()
    for back in range(1, ORDER):
        before = np.zeros(len(symbol), np.int64)
        before[back:] = symbol[:-back]
        before[position < back] = 0
        gram |= before << (SYMBOL_BITS * back)
    return owner, gram


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over the texts of all rows of ``docs`` (lang, text)."""

    def count(batches):
        held: list[pd.Series] = []

        def fold():
            total = pd.concat(held).groupby(level=[0, 1]).sum() if held else None
            held[:] = [] if total is None else [total]

        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                langs, names = pd.factorize(np.array(part.column(0).to_pylist(), object))
                owner, gram = sequence(flat(part.column(1)))
                key = (langs[owner].astype(np.int64) << (SYMBOL_BITS * ORDER)) | gram
                codes, unique = pd.factorize(key)
                n = np.bincount(codes, minlength=len(unique))
                index = [names[unique >> (SYMBOL_BITS * ORDER)], unique & ((1 << SYMBOL_BITS * ORDER) - 1)]
                held.append(pd.Series(n, index=pd.MultiIndex.from_arrays(index)))
                if sum(map(len, held)) > 1_000_000:
                    fold()
        fold()
        for total in held:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(total.index.get_level_values(0), pa.string()),
                    pa.array(total.index.get_level_values(1).to_numpy(np.int64)),
                    pa.array(total.to_numpy(np.int64)),
                ],
                ["lang", "gram", "n"],
            )

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, kind, key, value) with natural logs. kind 2m: probability of the m-gram ``key``;
    kind 2m + 1: weight the context ``key`` of m-grams leaves to order m - 1."""
    tables = {ORDER: counts.select("lang", "gram", F.col("n").alias("c"))}
    for m in range(ORDER - 1, 0, -1):  # lower orders count the distinct symbols in front
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (SYMBOL_BITS * m)) - 1))
        tables[m] = tables[m + 1].groupBy("lang", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    lower, out = None, None
    for m in range(1, ORDER + 1):
        grams = written(tables[m].withColumn("ctx", F.shiftright("gram", SYMBOL_BITS)), f"grams-{m}")
        once, twice = (F.sum((F.col("c") == x).cast("double")) for x in (1, 2))
        discount = grams.groupBy("lang").agg(
            F.least(F.lit(0.95), F.greatest(F.lit(0.1), F.coalesce(
                F.try_divide(once, once + 2 * twice), F.lit(0.75)))).alias("d")
        )
        contexts = grams.groupBy("lang", "ctx").agg(
            F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds")
        ).join(F.broadcast(discount), "lang")
        contexts = contexts.withColumn("left", F.col("d") * F.col("kinds") / F.col("total"))
        rows = grams.join(contexts, ["lang", "ctx"])
        if lower is None:
            below = F.lit(1.0 / (1 << SYMBOL_BITS))
        else:
            below = F.col("below")
            rows = rows.withColumn(
                "short", F.col("gram").bitwiseAND(F.lit((1 << (SYMBOL_BITS * (m - 1))) - 1))
            ).join(lower, ["lang", "short"])
        p = F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("left") * below
        done = written(rows.select("lang", "gram", p.alias("p")), f"probabilities-{m}")
        lower = done.select("lang", F.col("gram").alias("short"), F.col("p").alias("below"))
        for kind, part in (
            (2 * m, done.select("lang", F.col("gram").alias("key"), F.log("p").alias("value"))),
            (2 * m + 1, contexts.select("lang", F.col("ctx").alias("key"), F.log("left").alias("value"))),
        ):
            part = part.select("lang", F.lit(kind).alias("kind"), "key", "value")
            out = part if out is None else out.unionByName(part)
    return out


def hashed(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) >> np.uint64(64 - HASH_BITS)).astype(np.uint32)


@dataclasses.dataclass
class Model:
    """Sorted hash arrays by (language, kind); what calibration found per language."""

    langs: list[str]
    arrays: dict
    limits: list = dataclasses.field(default_factory=list)
    scale: float = 1.0

    def _look(self, lang: int, kind: int, hashes: np.ndarray):
        keys, values = self.arrays.get((lang, kind), (None, None))
        if keys is None:
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.float32)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return keys[at] == hashes, values[at]

    def logs(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of every n-gram, a column per language."""
        out = np.zeros((len(grams), len(self.langs)), np.float32)
        shown = {}
        for m in range(1, ORDER + 1):
            short = grams & ((1 << (SYMBOL_BITS * m)) - 1)
            shown[2 * m], shown[2 * m + 1] = hashed(short), hashed(short >> SYMBOL_BITS)
        for lang in range(len(self.langs)):
            at = np.arange(len(grams))
            for m in range(ORDER, 0, -1):
                found, value = self._look(lang, 2 * m, shown[2 * m][at])
                out[at[found], lang] += value[found]
                at = at[~found]
                found, value = self._look(lang, 2 * m + 1, shown[2 * m + 1][at])
                out[at, lang] += np.where(found, value, 0)
            out[at, lang] -= np.log(1 << SYMBOL_BITS)
        return out

    def entropies(self, texts: pa.Array):
        """(symbols of every text, cross-entropy per symbol [texts, languages])."""
        owner, gram = sequence(texts)
        codes, unique = pd.factorize(gram)
        logs = self.logs(unique)
        n = np.bincount(owner, minlength=len(texts))
        total = np.stack(
            [np.bincount(owner, logs[codes, k], len(texts)) for k in range(len(self.langs))], axis=1
        )
        return n, -total / np.maximum(n, 1)[:, None]


def train(docs: DataFrame) -> Model:
    """Model of the rows of ``docs`` (lang, text) with a lang. Its arrays hold at most
    languages x 2 ORDER x 2**HASH_BITS entries of 8 bytes, whatever the size of ``docs``."""
    labelled = docs.where("lang is not null and text is not null")
    rows = kneser_ney(written(gram_counts(labelled), "gram-counts"))

    def compact(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(hashed(b.column(2).to_numpy()).astype(np.int32)),
                 b.column(3).cast(pa.float32())], ["lang", "kind", "hash", "value"],
            )

    rows = rows.mapInArrow(compact, "lang string, kind int, hash int, value float")
    rows = written(rows.groupBy("lang", "kind", "hash").agg(F.max("value").alias("value")), "model")
    langs = [r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    arrays = {}
    for k, lang in enumerate(langs := sorted(langs)):
        got = rows.where(F.col("lang") == lang).select("kind", "hash", "value").toArrow()
        kind, key, value = (got.column(i).to_numpy() for i in range(3))
        for x in np.unique(kind):
            mine = kind == x
            order = np.argsort(key[mine])
            arrays[k, int(x)] = key[mine][order].astype(np.uint32), value[mine][order]
    return Model(langs, arrays)


def calibrate(model: Model, docs: DataFrame) -> Model:
    """Limits and scale from labelled documents that the counts have not seen.

    Cross-entropies of a language spread around their mean with a variance a + b / n for texts of n
    symbols: a from the longer half, b from the shorter half of its texts.
    """
    if not model.langs:
        return model

    def measure(texts):
        n, h = model.entropies(texts)
        return [pa.array(n), pa.array(list(h), pa.list_(pa.float64()))]

    known = F.array(*(F.lit(x) for x in model.langs))
    rows = per_text(docs.where("lang is not null"), "n long, h array<double>", measure, ["lang"])
    rows = rows.where("n > 0").withColumn("at", F.array_position(known, F.col("lang")).cast("int"))
    rows = written(rows.where("at > 0").withColumn("own", F.element_at("h", F.col("at"))), "calibration")
    means = rows.groupBy("lang").agg(
        F.avg("own").alias("mean"), F.percentile_approx("n", 0.5).alias("middle")
    )
    square = (F.col("own") - F.col("mean")) ** 2
    spread = rows.join(F.broadcast(means), "lang").groupBy("lang", "mean").agg(
        F.coalesce(F.avg(F.when(F.col("n") >= F.col("middle"), square)), F.lit(0.0)).alias("a"),
        F.coalesce(F.avg(F.when(F.col("n") < F.col("middle"), square * F.col("n"))), F.lit(0.0)).alias("b"),
    )
    found = {r["lang"]: (r["mean"], r["a"], r["b"]) for r in spread.collect()}

    def loss_at(scale):
        def weigh(total, x):
            return total + F.exp(scale * F.sqrt("n") * (F.col("own") - x))

        return F.avg(F.log(F.aggregate("h", F.lit(0.0), weigh)))

    losses = [loss_at(k).alias(f"k{i}") for i, k in enumerate(SCALES)]
    loss = rows.agg(*losses).first()
    scored = [(x, k) for x, k in zip(loss, SCALES, strict=True) if x is not None]
    model.limits = [found.get(x) for x in model.langs]
    model.scale = min(scored)[1] if scored else 1.0
    return model


ADDED = "lang_pred string, score double, cross_entropy double, rejected boolean"


def predicted(model: Model, texts: pa.Array, tolerance: float = TOLERANCE):
    n, h = model.entropies(texts) if model.langs else (np.zeros(len(texts), int), None)
    if h is None:
        h = np.zeros((len(texts), 1))
    best = h.argmin(axis=1)
    low = h[np.arange(len(h)), best]
    share = np.exp(-model.scale * np.sqrt(n)[:, None] * (h - low[:, None])).sum(axis=1)
    limit = np.array([
        np.inf if not model.limits or model.limits[b] is None
        else model.limits[b][0] + max(
            LEAST_EXCESS, tolerance * (model.limits[b][1] + model.limits[b][2] / max(k, 1)) ** 0.5
        )
        for b, k in zip(best, n, strict=True)
    ])
    some = n > 0
    names = np.array([*model.langs, "und"], object)[np.where(some, best, -1)]
    return [
        pa.array(names, pa.string()),
        pa.array(np.where(some, 1 / share, 0.0)),
        pa.array(np.where(some, low, 0.0)),
        pa.array(~some | (low > limit)),
    ]


def fold(docs: DataFrame):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))


def fitted(docs: DataFrame) -> Model:
    """Model of the documents whose fold is 1 to 4: counts from 2 to 4, limits from 1."""
    small_batches(docs.sparkSession)
    return calibrate(train(docs.where(fold(docs).isin(2, 3, 4))), docs.where(fold(docs) == 1))


def identified(docs: DataFrame, model: Model, keep=("doc_id",)) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``) with lang_pred, score (0 to 1), cross_entropy (nats per
    symbol) and rejected.

    Null texts and texts without a letter are ``und``, score 0, rejected. Without any labelled text
    all are. Only the text is looked at; languages that tie go by name. Repeated rows each get their
    result, an empty table an empty one.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return per_text(docs, ADDED, lambda texts: predicted(sent.value, texts), keep, most=PIECE)
