"""Pre-tokens of many texts at once by the published byte-level pattern, in numpy over UTF-8 bytes.

It covers texts of printable ASCII, tab, line ends and Latin letters up to U+024F, where each byte
shows its class: letters, digits, white space, others. A pre-token begins where the class changes, one
space goes with what follows it, and white space before a word leaves its last character to itself.
"""

import itertools

import numpy as np
import pandas as pd

from .words import mix

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LETTER, _DIGIT, _OTHER, _SPACE = 1, 2, 3, 4
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _kinds() -> np.ndarray:
    """Class of each byte; 0 for those that no covered text holds."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = _OTHER
    kind[ord("0") : ord("9") + 1] = _DIGIT
    for begin, end in ((ord("A"), ord("Z")), (ord("a"), ord("z")), (0x80, 0xBF), (0xC3, 0xC9)):
        kind[begin : end + 1] = _LETTER
    kind[list(b"\t\n\r ")] = _SPACE
    return kind


_KIND = _kinds()


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each with a zero byte after it, and where each begins (one more at the end).

    Eight more zero bytes follow."""
    at = np.fromiter(itertools.accumulate((len(x) + 1 for x in texts), initial=0), np.int64, len(texts) + 1)
    return np.frombuffer(b"\0".join([*texts, b"\0" * 8]), np.uint8), at


def covered(texts: list[bytes]) -> np.ndarray:
    """Whether each text holds only characters that this module cuts."""
    data, at = _joined(texts)
    bad = _KIND[data[: at[-1]]] == 0
    bad[at[1:] - 1] = False
    places = [np.flatnonzero(bad)]
    for lead, odd in ((0xC3, lambda x: (x == 0x97) | (x == 0xB7)), (0xC9, lambda x: x > 0x8F)):
        found = np.flatnonzero(data[: at[-1]] == lead)
        places.append(found[odd(data[found + 1])])  # signs among the letters; beyond U+024F
    out = np.ones(len(texts), bool)
    out[np.searchsorted(at, np.concatenate(places), side="right") - 1] = False
    return out


def _hashes(words, count: int, size: np.ndarray) -> np.ndarray:
    out = mix(size.astype(np.uint64) + _ODD)
    for on, word in words(np.arange(count)):
        out[on] = mix(out[on] * _ODD + word)
    return out


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each value, and the place where each number first stands."""
    code, _ = pd.factorize(values)
    shown = np.zeros(code.max(initial=-1) + 1, np.int64)
    shown[code[::-1]] = np.arange(len(code))[::-1]
    return code, shown


class Remembered:
    """Ids of distinct pre-tokens, found once by ``learn`` (a list of them to a dictionary) and kept in
    two generations of ``most`` / 2; those longer than ``longest`` bytes are not kept."""

    def __init__(self, learn, most: int, longest: int):
        self.learn, self.most, self.longest = learn, most, longest
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def ids(self, distinct: list[bytes]) -> list[bytes]:
        if len(self.known) > self.most // 2:
            self.before, self.known = self.known, {}
        found = list(map(self.known.get, distinct))
        lacking = [i for i, x in enumerate(found) if x is None]
        earlier = [self.before.get(distinct[i]) for i in lacking]
        new = self.learn([distinct[i] for i, x in zip(lacking, earlier, strict=True) if x is None])
        for i, x in zip(lacking, earlier, strict=True):
            piece = distinct[i]
            found[i] = ids = new[piece] if x is None else x
            if len(piece) <= self.longest:
                self.known[piece] = ids
        return found


class Cuts:
    """Pre-tokens of covered texts: ``code`` numbers the different ones, ``pieces`` are these."""

    def __init__(self, texts: list[bytes]):
        data, at = _joined(texts)
        n = int(at[-1])
        self.data = data
        kind = _KIND[data[:n]]
        start = np.ones(n, bool)
        start[1:] = kind[1:] != kind[:-1]
        word = (kind != 0) & (kind != _SPACE)
        start[1:] &= ~(word[1:] & (data[:n][:-1] == 0x20))
        start[:-1] |= (kind[:-1] == _SPACE) & word[1:]
        quote = np.flatnonzero((data[:n] == ord("'")) & start)
        one, two = data[quote + 1], data[quote + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
        long |= (one == ord("l")) & (two == ord("l"))
        start[quote[short | long] + 1] = False
        start[quote[short] + 2] = True
        start[quote[long] + 3] = True
        begin = np.flatnonzero(start)
        end = np.append(begin[1:], n)
        held = kind[begin] != 0
        self.begin, self.end = begin[held], end[held]
        self.first = np.searchsorted(self.begin, at)
        self.code, shown = self._distinct()
        raw = data.tobytes()
        spans = zip(self.begin[shown].tolist(), self.end[shown].tolist(), strict=True)
        self.pieces = [raw[a:b] for a, b in spans]

    def _words(self, tokens: np.ndarray):
        """(which of ``tokens``, their next eight bytes as a number) until all their bytes came."""
        eight = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        on, begin, size = np.arange(len(tokens)), self.begin[tokens], (self.end - self.begin)[tokens]
        while len(on):
            unused = ((8 - np.minimum(size, 8)) * 8).astype(np.uint64)
            yield on, eight[begin] << unused >> unused
            more = size > 8
            on, begin, size = on[more], begin[more] + 8, size[more] - 8

    def _distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Number of each pre-token's bytes, and a pre-token of each number."""
        size = self.end - self.begin
        code, shown = _numbered(_hashes(self._words, len(size), size))
        like = shown[code]
        same = (size[like] == size).all()
        if same:
            both = zip(self._words(np.arange(len(size))), self._words(like), strict=True)
            same = all((x[1] == y[1]).all() for x, y in both)
        if not same:  # different bytes of one hash
            spans = zip(self.begin.tolist(), self.end.tolist(), strict=True)
            raw = self.data.tobytes()
            code, shown = _numbered(np.array([raw[a:b] for a, b in spans], object))
        return code, shown

    def coded(self, ids: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, from those of each of ``pieces``."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin = np.cumsum(size) - size
        counts = size[self.code]
        ends = np.append(0, np.cumsum(counts))
        at = np.repeat(begin[self.code] - ends[:-1], counts) + np.arange(ends[-1])
        out = flat[at].tobytes()
        edges = (4 * ends[self.first]).tolist()
        return [out[a:b] for a, b in itertools.pairwise(edges)]
