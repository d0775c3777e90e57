"""Byte-level BPE by a file of ranks: encoding in two tiers, and decoding.

A text is cut into pre-tokens by the vocabulary's pattern. Tier one: a minimal perfect hash over the
vocabulary finds the pre-tokens that are entries as a whole; the entry found is compared byte by byte.
Tier two, for the others: the bytes are a linked list, pairs of neighbours wait in a heap by (rank,
place), and the best pair is joined until none is an entry. The pattern's letter, number and space
classes are those of the library whose result is asked for, read off it once on the driver, since
classes differ between Unicode versions.
"""

import base64
import functools
import heapq
import itertools
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens
from .common import per_text, small_batches
from .perfect import PerfectHash
from .pretokens import Cuts, Remembered, covered
from .words import mix

# Pre-tokens a worker remembers, in two generations of half as many; longer ones are not kept.
REMEMBERED, REMEMBERED_BYTES = 600_000, 64
# Texts of code points up to this one are cut with classes that end there.
NARROW = 0x24F
_WIDE = re.compile(f"[^\\x00-{chr(NARROW)}]").search
_ODD = 0x9E3779B97F4A7C15
# A waiting pair is one number: its rank, and below that its place.
_PLACE_BITS = 40
_PLACE_MASK = (1 << _PLACE_BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@functools.lru_cache(2)
def _classes(most: int) -> dict[str, str]:
    """Bodies of character classes for letters, numbers and white space, as the library has them, of
    the code points up to ``most``."""
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    ranks = {bytes([i]): i for i in range(256)}
    out = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        cut = tiktoken.Encoding("bytes", pat_str=name, mergeable_ranks=ranks, special_tokens={})
        points = np.array([ord(c) for c in cut.decode(cut.encode_ordinary(every))])
        points = points[points <= most]
        edge = np.flatnonzero(np.diff(points) > 1)
        begin, end = points[np.append(0, edge + 1)], points[np.append(edge, len(points) - 1)]
        out[name] = "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in zip(begin, end, strict=True))
    return out


def compiled(pattern: str, most: int = 0x10FFFF) -> str:
    r"""``pattern`` for Python's re, with \p{L}, \p{N}, \s and \S written out, for texts of code
    points up to ``most``."""
    body = _classes(most)
    inside = re.compile(r"\[[^\]]*\]")

    def written_out(part: str, wrap: bool) -> str:
        for name, chars in body.items():
            part = part.replace(name, f"[{chars}]" if wrap else chars)
        return part.replace(r"\S", rf"[^{body[r'\s']}]") if wrap else part

    out, at = [], 0
    for m in inside.finditer(pattern):
        out += [written_out(pattern[at : m.start()], True), written_out(m.group(), False)]
        at = m.end()
    return "".join([*out, written_out(pattern[at:], True)])


def byte_hashes(items: list[bytes]) -> np.ndarray:
    """64-bit hash of each byte string, all at once: eight bytes a step over those still going on."""
    size = np.array([len(x) for x in items], np.int64)
    data = np.frombuffer(b"".join(items) + b"\0" * 8, np.uint8)
    begin = np.cumsum(size) - size
    out = mix(size.astype(np.uint64) + np.uint64(_ODD))
    on, step = np.flatnonzero(size > 0), 0
    while len(on):
        at = begin[on] + step
        left = np.minimum(size[on] - step, 8)
        word = np.ascontiguousarray(data[at[:, None] + np.arange(8)]).view("<u8").ravel()
        unused = ((8 - left) * 8).astype(np.uint64)
        word = word << unused >> unused
        out[on] = mix(out[on] * np.uint64(_ODD) + word)
        step += 8
        on = on[size[on] > step]
    return out


class Vocabulary:
    """Entries of a rank file under their minimal perfect hash: id and bytes at each index."""

    def __init__(self, ranks: dict[bytes, int]):
        entries = list(ranks)
        lacking = [i for i in range(256) if bytes([i]) not in ranks]
        if lacking:
            raise ValueError(f"no entry for the single bytes {lacking}")
        hashes = byte_hashes(entries)
        if len(np.unique(hashes)) < len(entries):
            raise ValueError("two entries have one 64-bit hash")
        self.hash = PerfectHash.of(hashes)
        order = np.argsort(self.hash.index(hashes))
        self.entry = [entries[i] for i in order]
        self.id = np.array([ranks[x] for x in self.entry], np.int64)
        self.ranks = ranks

    def whole(self, items: list[bytes]) -> list[int]:
        """Id of each item that is an entry, else -1."""
        at = self.hash.index(byte_hashes(items))
        ids = self.id[at]
        same = (a >= 0 and self.entry[a] == x for a, x in zip(at.tolist(), items, strict=True))
        return np.where(np.fromiter(same, bool, len(items)), ids, -1).tolist()

    def merged(self, item: bytes) -> list[int]:
        """Ids by joining neighbours, the lowest rank first, the leftmost of equal ones."""
        n = len(item)
        ranks = self.ranks.get
        end = list(range(1, n + 1))  # of the part that begins here
        before = list(range(-1, n - 1))
        joined = [ranks(item[i : i + 2], -1) for i in range(n - 1)]  # rank of a part with the next one
        joined.append(-1)
        heap = [rank << _PLACE_BITS | i for i, rank in enumerate(joined) if rank >= 0]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            first = pop(heap)
            i = first & _PLACE_MASK
            if joined[i] != first >> _PLACE_BITS:
                continue
            middle = end[i]
            end[i] = last = end[middle]
            joined[middle] = joined[i] = -1
            if last < n:
                before[last] = i
                joined[i] = rank = ranks(item[i : end[last]], -1)
                if rank >= 0:
                    push(heap, rank << _PLACE_BITS | i)
            if i:
                j = before[i]
                joined[j] = rank = ranks(item[j:last], -1)
                if rank >= 0:
                    push(heap, rank << _PLACE_BITS | j)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[item[i : end[i]]])
            i = end[i]
        return out


class Encoder:
    """Ids of whole texts; those of a distinct pre-token are found once and remembered."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, narrow: str, published: bool = False):
        """``narrow`` is the pattern for texts of code points up to ``NARROW``: shorter classes.
        ``published``: the pattern is that of ``pretokens``, which cuts the texts that it covers."""
        self.published = published
        self.vocabulary = vocabulary
        self.wide, self.narrow = re.compile(pattern).findall, re.compile(narrow).findall
        self.remembered = Remembered(self.learn, REMEMBERED, REMEMBERED_BYTES)

    def learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        merged = self.vocabulary.merged
        ids = [
            [whole] if whole >= 0 else merged(x)
            for x, whole in zip(new, self.vocabulary.whole(new), strict=True)
        ]
        raw = np.array(list(itertools.chain.from_iterable(ids)), "<i4").tobytes()
        ends = itertools.accumulate((4 * len(x) for x in ids), initial=0)
        return dict(zip(new, (raw[a:b] for a, b in itertools.pairwise(ends)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        raw = [x.encode() for x in texts]
        fast = covered(raw).tolist() if self.published else [False] * len(raw)
        cuts = Cuts(list(itertools.compress(raw, fast)))
        coded = iter(cuts.coded(self.remembered.ids(cuts.pieces)))
        slow = [
            (self.wide if _WIDE(x) else self.narrow)(x) for x, f in zip(texts, fast, strict=True) if not f
        ]
        distinct = list(set().union(*slow))
        ids = dict(zip(distinct, self.remembered.ids([x.encode() for x in distinct]), strict=True))
        joined = (b"".join(map(ids.__getitem__, cut)) for cut in slow)
        return [next(coded) if f else next(joined) for f in fast]


# One encoder a worker and broadcast, so that what is remembered outlives a task.
_encoders: dict = {}


def _encoder(shared) -> Encoder:
    key = id(shared.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(*shared.value)
    return _encoders[key]


def _lists(data: list[bytes], kind) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in data)])
    values = pa.array(np.frombuffer(b"".join(data), "<i4"))
    if ends[-1] >= 1 << 31:
        return pa.array([np.frombuffer(x, "<i4") for x in data], kind)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def encoded(docs: DataFrame, ranks: str, pattern: str, keep=("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ids (array<int>) of every text by the rank file ``ranks``.

    A null text is an empty one and has no ids; a row without doc_id, repeated rows and rows of equal
    texts get a row each. Texts of any length are encoded whole; long ones one at a time. Special
    tokens are not known: their strings are plain text. An empty table gives no rows. Other columns
    are not looked at; a kept column named ids is replaced. The broadcast holds the vocabulary file
    alone, whatever the input.
    """
    small_batches(docs.sparkSession)
    parts = Vocabulary(read_ranks(ranks)), compiled(pattern), compiled(pattern, NARROW)
    parts = *parts, pattern == pretokens.PATTERN
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def encode(texts):
        return [_lists(_encoder(shared).encode(texts.to_pylist()), pa.list_(pa.int32()))]

    return per_text(docs, "ids array<int>", encode, keep)


def decoded(rows: DataFrame, ranks: str, keep=("doc_id",)) -> DataFrame:
    """Columns ``keep`` and decoded (binary): the bytes of the column ids, one row for each.

    Null ids are none. An id without an entry is an error.
    """
    entries = {i: x for x, i in read_ranks(ranks).items()}
    shared = rows.sparkSession.sparkContext.broadcast(entries)
    kept = [c for c in keep if c != "decoded"]
    source = rows.select(*kept, "ids")

    def run(batches):
        entry = shared.value.__getitem__
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                texts = [b"".join(map(entry, x)) if x else b"" for x in part.column(len(kept)).to_pylist()]
                columns = [*part.columns[: len(kept)], pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "decoded"])

    schema = source.select(*kept).schema.add("decoded", "binary")
    return source.mapInArrow(run, schema)


def digest(rows: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    rows = rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), "ids"
    )
    kept = ("doc_id", "n_tokens", "ids_sha256")
    return decoded(rows, ranks, kept).select(*kept, F.sha2("decoded", 256).alias("decoded_sha256"))
