"""Words of many texts at once: positions and 64-bit hashes, by numpy over UTF-8 bytes."""

import functools

import numpy as np
import pyarrow as pa

from .common import utf8

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base):
        out = np.full(size + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return of(_MULTIPLIER), of(pow(_MULTIPLIER, -1, 1 << 64))


@functools.lru_cache(1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def lowered_alnum() -> np.ndarray:
    """Byte map for words of ASCII letters and digits (lower-cased) and all non-ASCII bytes."""
    keep = np.zeros(256, np.uint8)
    for b in range(256):
        c = b + 32 if 0x41 <= b <= 0x5A else b
        if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A:
            keep[b] = c
    return keep


_LOWERED = lowered_alnum()


class Words:
    """``hash[i]`` of word i in text order; text d has words ``first[d]`` up to ``first[d + 1]``."""

    def __init__(self, texts: pa.Array):
        data, at = utf8(texts)
        shown = _LOWERED[data]
        word = shown != 0
        before = np.empty_like(word)
        after = np.empty_like(word)
        if len(word):
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
            edges = at[(at > 0) & (at < len(word))]
            before[edges] = False
            after[edges - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        size = 1 << max(20, int(len(data)).bit_length())
        power, inverse = _powers(size)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values()[shown] * word * power[: len(data)], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start])
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)

    def texts(self) -> np.ndarray:
        """Text number of every word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and whether they lie in one text."""
        size = len(self.hash) - n + 1
        if size <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = np.zeros(size, np.uint64)
        for j in range(n):
            out *= np.uint64(_MULTIPLIER)
            out += self.hash[j : j + size]
        last = np.repeat(self.first[1:], self.count)[:size]
        return mix(out), np.arange(size) + n <= last
