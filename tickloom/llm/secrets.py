"""Secrets by a linear-chain conditional random field.

Base spans come from fixed patterns. Tokens are tagged begin, inside or outside of a secret from
their own shape, the shapes of their neighbours and features of the file; the tags of a text are
those of the best path (Viterbi). The field is fitted to token windows labelled by the base spans.

Decoding is exact but looks only at few tokens: where a token prefers *outside* by more than all that
its two transitions can weigh, the best path is outside there, so the text falls apart into short
stretches between such tokens.
"""

import bisect
import dataclasses
import itertools
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat, joined_sha, per_text, pieces, small_batches, written
from .words import mix

KINDS = ("assign", "access", "hex")
# The field is fitted to at most so many windows with, and as many without a base span.
WINDOWS = 1500
REACH = 12
OUTSIDE, BEGIN, INSIDE = range(3)
LEAST = 6

_ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# Java pattern that every text with a base span matches.
MAY_HOLD = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
)
_TOKEN = re.compile(r"[A-Za-z0-9+/_.-]+|[^\sA-Za-z0-9+/_.-]")
_KEY = re.compile(r"(?ai:pass|secret|token|key|auth|cred|bearer)")
_PREFIX = re.compile(r"(?m:^)(?:AKIA|ASIA|gh[pousr]_|xox[abp]-|sk_|pk_|eyJ|AIza)")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value), by start, then kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m.start(1)) for m in _ASSIGN.finditer(text)
                if m.end(1) - m.start(1) >= LEAST]
    out += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text)
            if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(out)


# ---- features

_LENGTHS = (3, 6, 10, 16, 20, 24, 32, 40)


def _classes(*sets: bytes) -> np.ndarray:
    """For each byte, the number of the first set that has it, else the number of sets."""
    out = np.full(256, len(sets), np.uint8)
    for k in reversed(range(len(sets))):
        out[np.frombuffer(sets[k], np.uint8)] = k
    return out


_LOWER, _UPPER, _DIGITS = string.ascii_lowercase.encode(), string.ascii_uppercase.encode(), string.digits.encode()
_CASE = _classes(_LOWER, _UPPER, _DIGITS)
_HEXADECIMAL = _classes(b"0123456789abcdef") == 0
_MARKS = _classes(b"=:", b"\"'`", b"@+(.-")


def _entropies(data: np.ndarray, owner: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bits a character of each token; ``data`` has the characters, ``owner`` the token of each."""
    cells, count = np.unique(owner * 256 + data, return_counts=True)
    part = count / n[cells >> 8]
    return np.bincount(cells >> 8, -part * np.log2(part), len(n))


def shapes(tokens: list[str]) -> np.ndarray:
    """Own features [n, OWN] of tokens as ``_TOKEN`` finds them, from all their characters: ASCII, or
    a single character, which counts as none of letter, digit and mark if it is beyond ASCII."""
    data = np.frombuffer("".join(tokens).encode("latin-1", "replace"), np.uint8)
    n = np.fromiter(map(len, tokens), np.int64, len(tokens))
    if not len(n):
        return np.zeros((0, OWN))
    begin = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(n)), n)

    def total(flags):
        return np.add.reduceat(flags, begin, dtype=np.int64)

    case = _CASE[data]
    lower, upper, digit = (total(case == k) for k in range(3))
    changed = np.append(False, case[1:] != case[:-1])
    changed[begin] = False
    long, single, mark = n > 6, n == 1, _MARKS[data[begin]]
    chosen = long[owner]
    place = np.cumsum(long) - 1
    entropy = np.zeros(len(n))
    entropy[long] = _entropies(data[chosen], place[owner[chosen]], n[long])
    # Words that name a secret and beginnings of known keys, found in all tokens at once.
    lines = "\n" + "\n".join(tokens)
    starts = begin + np.arange(1, len(n) + 1)
    named, prefixed = np.zeros(len(n), bool), np.zeros(len(n), bool)
    for flags, pattern in ((named, _KEY), (prefixed, _PREFIX)):
        at = np.fromiter((m.end() for m in pattern.finditer(lines)), np.int64)
        flags[np.searchsorted(starts, at, "left") - 1] = True
    return np.stack([
        np.ones(len(n)),
        *(n > k for k in _LENGTHS),
        lower == n, upper == n, digit == n, lower + upper + digit == 0,
        (lower > 0) & (digit > 0), (upper > 0) & (digit > 0), (upper > 0) & (lower > 0),
        (total(_HEXADECIMAL[data]) == n) & long,
        np.where(long, total(changed) / np.maximum(1, n - 1), 0.0),
        np.maximum(0.0, entropy - 3.0),
        digit / n,
        named & (n < 24), prefixed,
        *(single & (mark == k) for k in range(3)),
        total(data == ord(".")) > 1, total((data == ord("/")) | (data == ord("+"))) > 0,
    ], axis=1).astype(np.float64)


OWN = 27
OFFSETS = (-2, -1, 0, 1)
FILE = 3


def file_features(text: str, tokens: list[str]) -> list[float]:
    n = max(1, len(tokens))
    return [
        min(1.0, 20 * text.count("=") / n),
        min(1.0, 4 * sum(map(text.count, "{};<>")) / n),
        float(n > 200),
    ]


@dataclasses.dataclass
class Field:
    """Weights by offset, feature and tag; of file features; of transitions."""

    near: np.ndarray
    file: np.ndarray
    moves: np.ndarray

    def bound(self) -> float:
        return 2 * float(self.moves.max() - self.moves.min())


def _scores(field: Field, x: np.ndarray, files: np.ndarray) -> np.ndarray:
    """Tag scores [n, L, 3] of windows with features x [n, L, OWN]."""
    out = np.repeat((files @ field.file)[:, None, :], x.shape[1], axis=1)
    for k, off in enumerate(OFFSETS):
        add = x @ field.near[k]
        if off < 0:
            out[:, -off:] += add[:, :off]
        elif off > 0:
            out[:, :-off] += add[:, off:]
        else:
            out += add
    return out


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def fit(x, files, tags, mask, rounds: int = 120, ridge: float = 1e-4) -> Field:
    """Field of greatest conditional likelihood for windows of tokens (Adam; forward-backward over
    all windows at once). ``mask`` is 0 beyond a window's tokens, which must come last."""
    field = Field(np.zeros((len(OFFSETS), OWN, 3)), np.zeros((FILE, 3)), np.zeros((3, 3)))
    field.moves[OUTSIDE, INSIDE] = -3.0
    n, length, _ = x.shape
    params = [field.near, field.file, field.moves]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    gold = np.eye(3)[tags] * mask[:, :, None]
    pair_mask = (mask[:, :-1] * mask[:, 1:])[:, :, None, None]
    gold_pairs = (gold[:, :-1, :, None] * gold[:, 1:, None, :] * pair_mask).sum(axis=(0, 1))
    for step in range(1, rounds + 1):
        s = _scores(field, x, files) * mask[:, :, None]
        forward, backward = np.zeros_like(s), np.zeros_like(s)
        forward[:, 0] = s[:, 0]
        for i in range(1, length):
            on = _logsum(forward[:, i - 1, :, None] + field.moves, 1) + s[:, i]
            forward[:, i] = np.where(mask[:, i, None] > 0, on, forward[:, i - 1])
        for i in range(length - 2, -1, -1):
            on = _logsum(field.moves + (s[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
            backward[:, i] = np.where(mask[:, i + 1, None] > 0, on, 0)
        total = _logsum(forward[:, -1], 1)
        single = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
        pairs = np.exp(
            forward[:, :-1, :, None] + field.moves
            + (s[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ) * pair_mask
        off = single - gold
        grads = []
        near = np.zeros_like(field.near)
        for k, shift in enumerate(OFFSETS):
            a, b = x, off
            if shift < 0:
                a, b = x[:, :shift], off[:, -shift:]
            elif shift > 0:
                a, b = x[:, shift:], off[:, :-shift]
            near[k] = a.reshape(-1, OWN).T @ b.reshape(-1, 3)
        grads = [near, files.T @ off.sum(axis=1), pairs.sum(axis=(0, 1)) - gold_pairs]
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            g = g / n + ridge * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags of a stretch, with *outside* before and after it."""
    best, back = moves[OUTSIDE] + scores[0], []
    for s in scores[1:]:
        on = best[:, None] + moves
        back.append(on.argmax(axis=0))
        best = on.max(axis=0) + s
    tags = [int((best + moves[:, OUTSIDE]).argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return np.array(tags[::-1])


# ---- training windows

WINDOW = "secret boolean, tokens array<string>, tags array<int>, file array<double>, pick long"


def windows(texts: pa.Array, row: np.ndarray | None = None):
    """Rows of WINDOW: around every base span, and one without from each text, by preference around
    a token with a digit."""
    out = []
    for value in texts:
        text = value.as_py()
        found = base_spans(text)
        places = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        if not places:
            continue
        tokens = [text[b:e] for b, e in places]
        file = file_features(text, tokens)
        tags = [OUTSIDE] * len(tokens)
        starts = np.array([b for b, _ in places])
        centres = []
        for _, _, end, begin in found:
            a, z = np.searchsorted(starts, [begin, end])
            for i in range(a, z):
                tags[i] = INSIDE if i > a or tags[i] == INSIDE else BEGIN
            if a < len(tokens):
                centres.append((True, int(a)))
        code = int(mix(np.array([hash_of(text)], np.uint64))[0])
        odd = [i for i, t in enumerate(tokens) if tags[i] == OUTSIDE and any(c.isdigit() for c in t)]
        free = odd or [i for i, t in enumerate(tags) if t == OUTSIDE]
        if free:
            centres.append((False, free[code % len(free)]))
        for secret, at in centres:
            s = slice(max(0, at - REACH), at + REACH + 1)
            pick = int(mix(np.array([code ^ at], np.uint64)).view(np.int64)[0])
            out.append((secret, tokens[s], tags[s], file, pick))
    return out


def hash_of(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode()) | len(text) << 32


def sampled(docs: DataFrame, most: int = WINDOWS) -> list:
    """At most ``most`` windows with and ``most`` without a secret, picked by a hash.

    Only as many texts as can fill the sample are cut into windows: those of the lowest hashes
    among the texts that may hold a base span, and among the others.
    """

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = windows(flat(part.column(0)))
                columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in range(5)]
                kinds = [pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.float64()),
                         pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["secret", "tokens", "tags", "file", "pick"],
                )

    # doc_id is in the hash so that a large group of copies does not share one place in the order
    order, likely = F.xxhash64("doc_id", "text"), F.col("text").rlike(MAY_HOLD)
    texts = docs.where("text is not null")
    places = written(texts.select(order.alias("place"), likely.alias("likely")), "sample-places")
    lowest = [
        places.where(F.col("likely") == kind).orderBy("place").limit(most).select("place")
        for kind in (True, False)
    ]
    # At most twice ``most`` rows.
    chosen = F.broadcast(lowest[0].unionByName(lowest[1]).distinct())
    made = texts.select(order.alias("place"), "text").join(chosen, "place", "left_semi")
    made = made.select("text").mapInArrow(run, WINDOW)
    made = written(made, "sample-windows")
    return [
        r
        for secret in (True, False)
        for r in made.where(F.col("secret") == secret).orderBy("pick", "tokens").limit(most).collect()
    ]


def fitted(docs: DataFrame, most: int = WINDOWS) -> Field | None:
    """The field for ``docs``; None where no text has a base span."""
    rows = sampled(docs, most)
    if not any(r["secret"] for r in rows):
        return None
    length = 2 * REACH + 1
    x = np.zeros((len(rows), length, OWN))
    tags, mask = np.zeros((len(rows), length), int), np.zeros((len(rows), length))
    for i, r in enumerate(rows):
        k = len(r["tokens"])
        x[i, :k] = shapes(r["tokens"])
        tags[i, :k], mask[i, :k] = r["tags"], 1
    return fit(x, np.array([r["file"] for r in rows]), tags, mask)


# ---- tagging


class Tagger:
    """Tags of whole texts; remembers the scores of tokens it has seen."""

    REMEMBERED = 500_000

    def __init__(self, field: Field):
        self.field, self.bound = field, field.bound()
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(OFFSETS), 3), np.float32)

    def _ids(self, tokens: list[str]) -> np.ndarray:
        if len(self.known) > self.REMEMBERED:
            self._forget()
        ids = np.fromiter(map(self.known.get, tokens, itertools.repeat(-1)), np.int64, len(tokens))
        missing = np.flatnonzero(ids < 0).tolist()
        if missing:
            new = list(dict.fromkeys(tokens[i] for i in missing))
            at = len(self.known)
            self.known.update(zip(new, range(at, at + len(new)), strict=True))
            if at + len(new) > len(self.table):
                grown = np.zeros((2 * (at + len(new)), len(OFFSETS), 3), np.float32)
                grown[: len(self.table)] = self.table
                self.table = grown
            self.table[at : at + len(new)] = np.einsum("nf,ofc->noc", shapes(new), self.field.near)
            ids[missing] = [self.known[tokens[i]] for i in missing]
        return ids

    def scores(self, texts: list[str], tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Tag scores of the tokens of all texts, one after the other, and the text of each."""
        ids = self._ids(list(itertools.chain.from_iterable(tokens)))
        owner = np.repeat(np.arange(len(texts)), list(map(len, tokens)))
        files = np.array([file_features(x, y) for x, y in zip(texts, tokens, strict=True)])
        out = self.table[ids, OFFSETS.index(0)] + (files.reshape(-1, FILE) @ self.field.file)[owner]
        for k, off in enumerate(OFFSETS):
            if off:
                here, there = slice(max(0, -off), min(0, -off) or None), slice(max(0, off), min(0, off) or None)
                inside = np.flatnonzero(owner[here] == owner[there])
                out[inside + max(0, -off)] += self.table[ids[there][inside], k]
        return out, owner

    def tags(self, texts: list[str], tokens: list[list[str]]) -> list[list[tuple[int, int]]]:
        """For each text (first token, token after the last) of every secret on the best path."""
        s, owner = self.scores(texts, tokens)
        first = np.cumsum([0, *map(len, tokens)])
        warm = np.flatnonzero(s[:, OUTSIDE] - s[:, 1:].max(axis=1) <= self.bound)
        apart = (np.diff(warm) > 1) | (np.diff(owner[warm]) > 0)
        found: list[list[tuple[int, int]]] = [[] for _ in texts]
        for stretch in np.split(warm, np.flatnonzero(apart) + 1):
            if not len(stretch):
                continue
            spans: list[list[int]] = []
            for i, tag in zip(stretch.tolist(), viterbi(s[stretch], self.field.moves), strict=True):
                if tag == BEGIN or tag == INSIDE and not (spans and spans[-1][1] == i):
                    spans.append([i, i + 1])
                elif tag == INSIDE:
                    spans[-1][1] = i + 1
            text = int(owner[stretch[0]])
            found[text] += [(int(a - first[text]), int(b - first[text])) for a, b in spans]
        return found

    def secrets(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text (start, kind, end) of its secrets."""
        out = []
        tagged = self.tags(texts, [_TOKEN.findall(x) for x in texts])
        for text, found in zip(texts, tagged, strict=True):
            spans = []
            places = [m.span() for m in _TOKEN.finditer(text)] if found else []
            for a, b in found:
                begin, end = places[a][0], places[b - 1][1]
                value = text[begin:end]
                if end - begin >= LEAST:
                    kind = 1 if value.startswith("AKIA") else 2 if re.fullmatch("[0-9a-f]+", value) else 0
                    spans.append((begin, kind, end))
            out.append(spans)
        return out


FOUND = "base array<struct<start:int,kind:byte,end:int>>, spans array<struct<start:int,kind:byte,end:int>>"
_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int8()), ("end", pa.int32())])


def found_in(tagger: Tagger | None, texts: pa.Array):
    base, spans = [], []
    texts = texts.to_pylist()
    for text, tagged in zip(texts, tagger.secrets(texts) if tagger else itertools.repeat([]), strict=False):
        fixed = [(b, k, e) for b, k, e, _ in base_spans(text)]
        starts = [b for b, _, _ in fixed]
        ends = [0, *itertools.accumulate((e for _, _, e in fixed), max)]
        more = [x for x in tagged if ends[bisect.bisect_left(starts, x[2])] <= x[0]]
        base.append(fixed)
        spans.append(sorted({*fixed, *more}))
    names = ("start", "kind", "end")
    return [
        pa.array([[dict(zip(names, x, strict=True)) for x in row] for row in rows], pa.list_(_SPAN))
        for rows in (base, spans)
    ]


_TAGGERS: dict = {}


def secrets(docs: DataFrame, field: Field | None, keep=("doc_id",)) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``) with ``base`` and ``spans``: arrays of (start, kind, end)
    in code points, end exclusive, kind a number into KINDS, by start, then kind.

    ``spans`` has all base spans and the tagged stretches that touch none. Null and empty texts have
    none; without a field there are only base spans. Repeated rows each get their spans; an empty
    table gives an empty result. Very long texts are tagged whole; the work grows with their tokens
    and spans. Of paths that score alike the one with the lower tags is taken. A kept column named
    ``base`` or ``spans`` is replaced.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(texts):
        if field_of(sent) is None:
            return found_in(None, texts)
        return found_in(tagger_of(sent), texts)

    return per_text(docs, FOUND, run, keep)


def field_of(sent):
    return sent.value


def tagger_of(sent) -> Tagger:
    """One tagger per worker and field, so that what it remembers serves later tasks."""
    if id(sent.value) not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[id(sent.value)] = Tagger(sent.value)
    return _TAGGERS[id(sent.value)]


def named(spans):
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.transform(
        spans, lambda x: F.concat_ws(":", F.get(names, x["kind"].cast("int")), x["start"], x["end"])
    )


def _count(kind: int):
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        *(_count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        joined_sha(named("base")).alias("base_sha256"),
        F.array_join(named("spans"), ",").alias("spans"),
    )
