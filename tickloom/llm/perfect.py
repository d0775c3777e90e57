"""Minimal perfect hashing of 64-bit keys, by numpy.

Keys are thrown into a bit array of twice their number; those that fall alone keep their place, the
others try again in a smaller array. A key's index is the number of set bits before its own, so n keys
take the indexes 0 to n - 1 and about four bits each. A key that is not of the set may get an index
too: whoever looks up compares the key stored there.
"""

import numpy as np

from .words import mix

SPACE = 2


_ODD, _MASK = 0x9E3779B97F4A7C15, 0xFFFFFFFFFFFFFFFF


def _places(keys: np.ndarray, words, level: int) -> np.ndarray:
    """Bit of each key in a level of 64 * ``words`` bits (one size, or one for each key)."""
    spread = mix(keys + np.uint64(_ODD * (level + 1) & _MASK)) >> np.uint64(32)
    bits = np.asarray(words, np.uint64) * np.uint64(64)
    return (spread * bits >> np.uint64(32)).astype(np.int64)


class PerfectHash:
    """Several sets of keys in one, each with levels of its own. ``levels[s]`` are the bit arrays of
    set s (uint64 words); its indexes follow those of the sets before."""

    def __init__(self, levels: list[list[np.ndarray]]):
        deepest = max(map(len, levels), default=0)
        none = np.zeros(0, np.uint64)
        by_level = [[x[i] if i < len(x) else none for x in levels] for i in range(deepest)]
        ones = [[int(np.bitwise_count(x).sum()) for x in row] for row in by_level]
        held = np.array(ones, np.int64).reshape(deepest, len(levels))
        self.first = np.concatenate([[0], np.cumsum(held.sum(axis=0))])
        self.size, self.parts = int(self.first[-1]), []
        before = self.first[:-1] + np.cumsum(held, axis=0) - held
        for row, start in zip(by_level, before, strict=True):
            words = np.array([len(x) for x in row], np.int64)
            bits = np.concatenate(row)
            count = np.bitwise_count(bits).astype(np.int64)
            inside = np.cumsum(count) - count
            begin = np.cumsum(words) - words
            base = np.repeat(start - np.append(inside, 0)[begin], words)
            self.parts.append((words, begin, bits, inside + base))

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        """For one set of distinct uint64 keys."""
        return cls([bit_levels(keys)])

    def index(self, keys: np.ndarray, sets=None) -> np.ndarray:
        """int64 index of each key, -1 where no level has its place; ``sets`` is the set of each."""
        out = np.full(len(keys), -1, np.int64)
        open_at, left = np.arange(len(keys)), keys.astype(np.uint64)
        of_set = np.zeros(len(keys), np.int64) if sets is None else sets
        for level, (words, begin, bits, before) in enumerate(self.parts):
            some = words[of_set] > 0
            if not some.all():
                open_at, left, of_set = open_at[some], left[some], of_set[some]
            if not len(left):
                break
            at = _places(left, words[of_set], level)
            place, bit = begin[of_set] + (at >> 6), (at & 63).astype(np.uint64)
            word = bits[place]
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_at[hit]] = before[place[hit]] + np.bitwise_count(below[hit])
            open_at, left, of_set = open_at[~hit], left[~hit], of_set[~hit]
        return out


def bit_levels(keys: np.ndarray) -> list[np.ndarray]:
    """The bit arrays for one set of distinct uint64 keys."""
    levels, left = [], keys.astype(np.uint64)
    while len(left):
        words = -(-SPACE * len(left) // 64)
        at = _places(left, words, len(levels))
        n = np.bincount(at, minlength=64 * words)
        levels.append(np.packbits(n == 1, bitorder="little").view("<u8"))
        left = left[n[at] != 1]
    return levels


def packed(levels: list[np.ndarray]) -> bytes:
    sizes = np.array([len(levels), *map(len, levels)], "<u8")
    return b"".join([sizes.tobytes(), *(x.tobytes() for x in levels)])


def unpacked(data: bytes) -> list[np.ndarray]:
    words = np.frombuffer(data, "<u8")
    n = int(words[0])
    ends = 1 + n + np.cumsum(words[1 : 1 + n].astype(np.int64))
    return [words[e - int(k) : e] for e, k in zip(ends, words[1 : 1 + n], strict=True)]
