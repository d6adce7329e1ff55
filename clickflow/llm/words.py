"""Words of whole texts as numpy arrays over UTF-8 bytes, with hashes of any run of words.

A word is a run of ASCII letters (A-Z lower-cased), digits and non-ASCII characters:
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing. Since every byte of a non-ASCII
character is 0x80 or more, the class can be taken byte by byte.
"""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.empty(max(n, 1), dtype=np.uint64)
    out[0], have = 1, 1
    with np.errstate(over="ignore"):
        while have < n:
            step = min(have, n - have)
            out[have:have + step] = out[:step] * (out[have - 1] * base)
            have += step
    return out


#: Powers are kept in steps of this many, 16 bytes each.
POWERS_STEP = 1 << 17

_cache: dict[str, np.ndarray] = {"up": _powers(BASE, 1), "down": _powers(BASE_INVERSE, 1)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each; kept up to 4 million per process."""
    if len(_cache["up"]) < n:
        size = -(-n // POWERS_STEP) * POWERS_STEP
        up, down = _powers(BASE, size), _powers(BASE_INVERSE, size)
        if size > 1 << 22:
            return up, down
        _cache.update(up=up, down=down)
    return _cache["up"], _cache["down"]


class RangeHash:
    """64-bit polynomial hashes of any ranges of a byte array. Equal ranges have equal hashes;
    callers compare the bytes where two different ranges with one hash would matter."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        h ^= h >> np.uint64(32)
        return h * np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The words of a run of texts. ``packed`` holds every word followed by one space, so any run of
    consecutive words is one byte range of it; ``starts``/``ends`` are each word's range there;
    ``raw_starts``/``raw_ends`` its range in the given bytes; ``first[i]:first[i + 1]`` are the words
    of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = LOWER[data]
        inside = IN_WORD[low]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        before = np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        before[cuts] = False
        after = np.empty_like(inside)
        after[-1:], after[:-1] = False, inside[1:]
        after[cuts - 1] = False
        begins = inside & ~before
        self.raw_starts = np.flatnonzero(begins)
        self.raw_ends = np.flatnonzero(inside & ~after) + 1
        lengths = self.raw_ends - self.raw_starts
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        self.packed = np.full(int(self.ends[-1]) + 1 if len(lengths) else 0, 0x20, dtype=np.uint8)
        if len(lengths):
            keep = np.ones(len(self.packed), dtype=bool)
            keep[self.ends] = False
            self.packed[keep] = low[inside]
        self.first = np.searchsorted(self.raw_starts, offsets)
        self.hashes = RangeHash(self.packed)

    def __len__(self) -> int:
        return len(self.starts)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of n words that lies within one text."""
        at = np.arange(max(0, len(self) - n + 1))
        if n > 1 and len(at):
            text_end = np.repeat(self.first[1:], np.diff(self.first))
            at = at[at + n <= text_end[at]]
        return at, self.hashes.of(self.starts[at], self.ends[at + n - 1])

    def bytes_of(self, word: int, n: int) -> bytes:
        """Words ``word .. word + n - 1``, joined by single spaces."""
        return self.packed[self.starts[word]:self.ends[word + n - 1]].tobytes()


def words_of(text: str | None) -> Words:
    """The words of one text."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    return Words(data, np.array([0, len(data)]))
