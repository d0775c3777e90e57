"""Benchmark decontamination by winnowing.

Of every window of consecutive k-word hashes the smallest are kept as fingerprints, on both sides.
A span of ``span`` shared words holds a whole window, so it always shares a fingerprint. Shared
fingerprints are extended to the whole windows of ``span`` words around them, whose words are hit.
An item with fewer words than ``span`` is one window of its own length.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat, joined_sha, per_text, small_batches, written
from .words import Words

SPAN, GRAM = 10, 5
# The index of the test side is sent to every task up to this many windows (about 40 bytes each).
INDEX_WINDOWS = 2_000_000

RESULT = "n_words long, hits array<struct<begin:int,end:int>>, items array<string>"


def winnow(grams: np.ndarray, inside: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Positions of the grams that are smallest in some window of their text (ties all kept).

    ``inside`` marks grams within one text, ``owner`` has the text of each.
    """
    n = len(grams) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = grams[:n].copy()
    for j in range(1, window):
        np.minimum(low, grams[j : j + n], out=low)
    whole = inside[:n] & inside[window - 1 :] & (owner[:n] == owner[window - 1 :])
    kept = np.zeros(len(grams), bool)
    for j in range(window):
        kept[j : j + n] |= whole & (grams[j : j + n] == low)
    return np.flatnonzero(kept)


def fingerprints(words: Words, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints of all texts."""
    grams, inside = words.grams(k)
    at = winnow(grams, inside, words.texts()[: len(grams)], span - k + 1)
    return at, grams[at]


class Index:
    """Windows of the test items by hash: full windows, and short items by their length."""

    def __init__(self, ids: list[str], texts: list[str], span: int = SPAN, k: int = GRAM):
        self.span, self.k = span, k
        words = Words(flat(pa.array(texts, pa.string())))
        owner = words.texts()
        _, marks = fingerprints(words, span, k)
        self.marks = np.unique(marks)
        self.tables = {}
        full, inside = words.grams(span)
        if inside.any():
            self._add(span, full[inside], owner[: len(full)][inside])
        for n in np.unique(words.count[(words.count > 0) & (words.count < span)]):
            grams, inside = words.grams(int(n))
            inside &= words.count[owner[: len(grams)]] == n
            self._add(int(n), grams[inside], owner[: len(grams)][inside])
        self.ids = ids

    def _add(self, n, hashes, owners):
        both = np.unique(np.rec.fromarrays([hashes, owners]))
        keys, begin = np.unique(both.f0, return_index=True)
        self.tables[n] = (keys, np.append(begin, len(both)), both.f1)

    def windows(self) -> int:
        return sum(len(x[2]) for x in self.tables.values())

    def find(self, n: int, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash in the table of n-word windows, or -1."""
        keys = self.tables[n][0]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, at, -1)

    def hits(self, words: Words):
        """(position, length, table row) arrays of every occurrence of a window."""
        span, k = self.span, self.k
        if span in self.tables and len(self.marks):
            at, marks = fingerprints(words, span, k)
            found = np.minimum(np.searchsorted(self.marks, marks), len(self.marks) - 1)
            at = at[self.marks[found] == marks]
            if len(at):  # extend: every window that holds the shared fingerprint
                grams, inside = words.grams(span)
                begin = np.unique((at[:, None] - np.arange(span - k + 1)).ravel())
                begin = begin[(begin >= 0) & (begin < len(grams))]
                begin = begin[inside[begin]]
                row = self.find(span, grams[begin])
                yield span, begin[row >= 0], row[row >= 0]
        for n in self.tables:
            if n < span:
                grams, inside = words.grams(n)
                begin = np.flatnonzero(inside)
                row = self.find(n, grams[begin])
                yield n, begin[row >= 0], row[row >= 0]


def runs(begin: np.ndarray, end: np.ndarray) -> list[dict]:
    """Disjoint ranges that cover the given ones."""
    out: list[dict] = []
    for i in np.argsort(begin, kind="stable"):
        b, e = int(begin[i]), int(end[i])
        if out and b <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], e)
        else:
            out.append({"begin": b, "end": e})
    return out


def judge(index: Index, texts: pa.Array):
    words = Words(texts)
    hits: list[list] = [[] for _ in words.count]
    items: list[set] = [set() for _ in words.count]
    spans: list[tuple] = []
    for n, begin, row in index.hits(words):
        _, first, owners = index.tables[n]
        doc = np.searchsorted(words.first, begin, side="right") - 1
        spans += zip(doc.tolist(), (begin - words.first[doc]).tolist(), [n] * len(doc), strict=True)
        for d, r in set(zip(doc.tolist(), row.tolist(), strict=True)):
            items[d].update(owners[first[r] : first[r + 1]].tolist())
    for d, b, n in spans:
        hits[d].append((b, b + n))
    return [
        pa.array(words.count, pa.int64()),
        pa.array(
            [runs(*np.array(x).T) if x else [] for x in hits],
            pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])),
        ),
        pa.array([sorted({index.ids[i] for i in x}) for x in items], pa.list_(pa.string())),
    ]


def _indexed(benchmark: DataFrame):
    rows = [(r[0], r[1]) for r in benchmark.collect()]
    return Index([r[0] for r in rows], [r[1] for r in rows])


def contamination(
    docs: DataFrame, benchmark: DataFrame, keep=("doc_id",), index_windows: int = INDEX_WINDOWS
) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``) with n_words, the hit word ranges and the items found.

    Null and empty texts have no words. Items without words or without an id are passed over; rows
    that share an item_id are one item with the windows of all. Repeated rows of ``docs`` each get
    their result. The test side, counted first, is sent to the tasks while it is within
    ``index_windows``; a larger one is worked through in blocks of that size against all documents
    and the ranges and items of the blocks are merged.
    """
    small_batches(docs.sparkSession)
    items = (
        benchmark.where("item_id is not null and text is not null")
        .select(F.col("item_id").cast("string").alias("item_id"), "text")
        .dropDuplicates()
    )
    # A window needs a word and a separator at least.
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 2
    if size <= index_windows:
        index = _indexed(items)
        return per_text(docs, RESULT, lambda texts: judge(index, texts), keep)
    blocks = -(-size // index_windows)
    items = written(items.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "items")
    found = docs.select(*keep, "text").withColumns(
        {"hits": F.expr("cast(array() as array<struct<begin:int,end:int>>)"),
         "items": F.expr("cast(array() as array<string>)"), "n_words": F.lit(0).cast("long")}
    )
    for block in range(blocks):
        index = _indexed(items.where(F.col("_block") == block).drop("_block"))

        def more(texts, index=index):
            return judge(index, texts)

        add = "n_words long, _hits array<struct<begin:int,end:int>>, _items array<string>"
        found = per_text(found, add, more, [*keep, "text", "hits", "items"])
        found = found.withColumn("hits", F.concat("hits", "_hits")).withColumn(
            "items", F.array_union("items", "_items")
        )
    return found.select(
        *keep, "n_words", merged_ranges("hits").alias("hits"), F.array_sort("items").alias("items")
    )


def merged_ranges(column: str):
    return F.aggregate(
        F.array_sort(column),
        F.expr("cast(array() as array<struct<begin:int,end:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["begin"] <= F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["begin"].alias("begin"),
                        F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["begin"]).alias(
            "n_hit"
        ),
        F.size("items").cast("long").alias("n_items"),
        joined_sha("items").alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
