"""Suffix arrays by induced sorting, and permuted longest common prefixes.

``suffix_array`` takes an array of non-negative integers that ends with its only 0. Suffixes are
classified as S (smaller than the next suffix) or L; the leftmost-S (LMS) substrings are sorted by one
induction, named, and their order found by recursion where names repeat; a second induction from the
sorted LMS suffixes gives the whole order. Both inductions are linear.

An induction goes bucket by bucket with numpy: what one bucket's entries induce lies in later buckets,
or at the end of the same one, which then is the next round's front. That wants few buckets, so the
recursion writes each name as two digits of a base near the root of the number of names; the text gets
shorter by a third or so each time all the same. A short text is sorted by the same method over lists.
"""

from __future__ import annotations

import numpy as np


SHORT = 1 << 16
#: Fewer suffixes than this are dealt one by one.
FEW = 16


def suffix_array(s: np.ndarray) -> np.ndarray:
    if len(s) <= SHORT:
        return np.array(_sais(s.tolist(), int(s.max()) + 1), dtype=np.int64)
    smaller = _types(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = _induced(s, smaller, lms)
    is_lms = np.zeros(len(s), dtype=bool)
    is_lms[lms] = True
    names = _names(s, lms, order[is_lms[order]])
    del order
    return _induced(s, smaller, lms[_order_of(names)])


def _order_of(names: np.ndarray) -> np.ndarray:
    """Suffix array of a name sequence (0 .. k - 1, its only 0 at the end)."""
    k = int(names.max()) + 1
    if k == len(names):
        return np.argsort(names)
    base = int(k ** 0.5) + 1
    digits = np.zeros(2 * len(names) + 1, dtype=np.uint16 if base < 65_000 else np.uint32)
    digits[:-1:2], digits[1::2] = names // base + 1, names % base + 1
    order = suffix_array(digits)
    return order[(order & 1 == 0) & (order < 2 * len(names))] >> 1


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (the last, the sentinel, is)."""
    change = np.flatnonzero(s[1:] != s[:-1])
    rises = s[change] < s[change + 1]
    out = np.ones(len(s), dtype=bool)
    out[:-1] = np.repeat(rises, np.diff(np.concatenate([[-1], change])))
    return out


def _induced(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes, induced from the LMS suffixes in the order given."""
    counts = np.bincount(s)
    tails = np.cumsum(counts)
    heads = tails - counts
    present = np.flatnonzero(counts).tolist()
    sa = np.full(len(s), -1, dtype=np.int64)

    def deal(at: np.ndarray, place: np.ndarray, back: bool) -> None:
        """Put suffixes at the next free places of their buckets, in the order given."""
        if not len(at):
            return
        if len(at) <= FEW:
            for i in at.tolist():
                c = s[i]
                if back:
                    place[c] -= 1
                sa[place[c]] = i
                if not back:
                    place[c] += 1
            return
        by = np.argsort(s[at], kind="stable")
        at = at[by]
        symbol = s[at]
        count = np.bincount(symbol, minlength=len(place))
        first, step = np.cumsum(count) - count, np.arange(len(at))
        if back:
            sa[(place - 1 + first)[symbol] - step] = at
            np.subtract(place, count, out=place)
        else:
            sa[(place - first)[symbol] + step] = at
            np.add(place, count, out=place)

    seeds = lms[np.argsort(s[lms], kind="stable")]
    until = np.cumsum(np.bincount(s[lms], minlength=len(counts))).tolist()
    place, larger_end = heads.copy(), {}
    for c in present:
        done = heads[c]
        while done < place[c]:
            front, done = sa[done:place[c]], place[c]
            at = front[front > 0] - 1
            deal(at[~smaller[at]], place, False)
        larger_end[c] = done
        deal(seeds[until[c - 1] if c else 0:until[c]] - 1, place, False)
    place = tails.copy()
    for c in reversed(present[1:]):
        done = tails[c]
        while done > place[c]:
            front, done = sa[place[c]:done][::-1], place[c]
            at = front[front > 0] - 1
            deal(at[smaller[at]], place, True)
        at = sa[heads[c]:larger_end[c]][::-1]
        at = at[at > 0] - 1
        deal(at[smaller[at]], place, True)
    sa[0] = len(s) - 1
    return sa


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings, in text order: equal for equal substrings, in sorted order."""
    rank = np.empty(len(s), dtype=np.int64)
    rank[lms] = np.arange(len(lms))
    ends = np.append(lms[1:] + 1, len(s))
    length = (ends - lms)[rank[ordered]]
    left, right = ordered[:-1], ordered[1:]
    differ = length[1:] != length[:-1]
    alike = np.flatnonzero(~differ)
    for lo in range(0, len(alike), 1 << 18):
        some = alike[lo:lo + (1 << 18)]
        w = length[some]
        step = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
        unlike = s[np.repeat(left[some], w) + step] != s[np.repeat(right[some], w) + step]
        differ[some] = np.add.reduceat(unlike, np.cumsum(w) - w) > 0
    names = np.empty(len(lms), dtype=np.int64)
    names[rank[ordered]] = np.concatenate([[0], np.cumsum(differ)])
    return names


def _sais(s: list[int], width: int) -> list[int]:
    """Suffix array of a list that ends with its only 0, over symbols 0 .. width - 1."""
    n = len(s)
    if n == 1:
        return [0]
    smaller = bytearray(n)
    smaller[n - 1] = 1
    for i in range(n - 2, -1, -1):
        a, b = s[i], s[i + 1]
        if a < b or (a == b and smaller[i + 1]):
            smaller[i] = 1
    lms = [i for i in range(1, n) if smaller[i] and not smaller[i - 1]]
    counts = np.bincount(np.array(s), minlength=width)
    tails = np.cumsum(counts)
    heads, tails = (tails - counts).tolist(), tails.tolist()

    def induced(seeds: list[int]) -> list[int]:
        sa, place = [-1] * n, tails[:]
        for i in reversed(seeds):
            c = s[i]
            place[c] -= 1
            sa[place[c]] = i
        place = heads[:]
        for i in sa:
            if i > 0 and not smaller[i - 1]:
                c = s[i - 1]
                sa[place[c]] = i - 1
                place[c] += 1
        place = tails[:]
        for at in range(n - 1, -1, -1):
            i = sa[at]
            if i > 0 and smaller[i - 1]:
                c = s[i - 1]
                place[c] -= 1
                sa[place[c]] = i - 1
        return sa

    order = np.array(induced(lms))
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    names = _names(np.array(s), np.array(lms), order[is_lms[order]])
    top = int(names.max()) + 1
    if top < len(names):
        return induced([lms[i] for i in _sais(names.tolist(), top)])
    return induced([lms[i] for i in np.argsort(names).tolist()])


def permuted_lcp(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phi, plcp) in text order: the suffix before each one in the array (-1 for the first), and the
    length of their common prefix. Where the symbols in front of both are equal it is one less than
    its left neighbour's; only the others are compared, four symbols at a time."""
    n = len(s)
    phi = np.empty(n, dtype=np.int64)
    phi[sa[0]], phi[sa[1:]] = -1, sa[:-1]
    at = np.arange(n)
    own = (phi <= 0) | (at == 0)
    own[1:] |= s[:-1] != s[np.maximum(phi[1:], 1) - 1]
    padded = np.concatenate([s, np.zeros(4, s.dtype)]).astype(np.uint64)
    four = padded[:n] | padded[1:n + 1] << np.uint64(16) | padded[2:n + 2] << np.uint64(32) | padded[3:n + 3] << np.uint64(48)
    plcp = np.zeros(n, dtype=np.int64)
    i = np.flatnonzero(own & (phi >= 0))
    left, right, length = i.copy(), phi[i], np.zeros(len(i), dtype=np.int64)
    while len(i):
        x = four[left] ^ four[right]
        equal = x == 0
        low = x & (~x + np.uint64(1))
        plcp[i[~equal]] = length[~equal] + (np.bitwise_count(low[~equal] - np.uint64(1)) >> 4)
        i, left, right, length = i[equal], left[equal] + 4, right[equal] + 4, length[equal] + 4
    since = np.maximum.accumulate(np.where(own, at, 0))
    return phi, np.where(own, plcp, plcp[since] - (at - since))
