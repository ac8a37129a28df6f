"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour; the leftmost smaller ones (LMS) are sorted first,
by their substrings and, where these repeat, by the ranks of what follows, over twice as many substrings in each round; the order of all
others is induced from theirs in two linear scans. The scans go bucket by bucket (a bucket: the suffixes with one first symbol), and
within a bucket in waves, so that each step handles an array instead of one suffix. Texts of large alphabets are scanned one by one.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are scanned by buckets.
SMALL = 1024


def classify(t: np.ndarray) -> np.ndarray:
    """True for S. The end of the text is smaller than any symbol, so the last suffix is L."""
    n = len(t)
    sign = np.zeros(n, np.int8)
    sign[:-1] = np.where(t[:-1] < t[1:], 1, np.where(t[:-1] > t[1:], -1, 0))
    sign[-1] = -1
    decided = np.where(sign != 0, np.arange(n), n - 1)
    following = np.minimum.accumulate(decided[::-1])[::-1]
    return sign[following] > 0


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in order."""
    first = t[lms]
    order = np.argsort(first, kind="stable")
    lms_sorted, starts = lms[order], np.searchsorted(first[order], np.arange(size + 1))
    large: list[list[np.ndarray]] = [[] for _ in range(size)]
    tail: list[list[np.ndarray]] = [[] for _ in range(size)]
    large[t[-1]].append(np.array([len(t) - 1]))

    def deal(of: np.ndarray, lists: list[list[np.ndarray]], kind: bool, own: int) -> np.ndarray:
        """Hand the left neighbours of a kind to their buckets; those of the own bucket are returned."""
        of = of[of > 0] - 1
        of = of[small[of] == kind]
        if not len(of):
            return of
        symbols = t[of]
        at = np.argsort(symbols, kind="stable")
        of, symbols = of[at], symbols[at]
        cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        mine = of[:0]
        for part, c in zip(np.split(of, cuts), symbols[np.concatenate([[0], cuts])]):
            if c == own:
                mine = part
            else:
                lists[c].append(part)
        return mine

    for c in range(size):
        wave = np.concatenate(large[c]) if large[c] else lms[:0]
        done = [wave]
        while len(wave):
            wave = deal(wave, large, False, c)
            done.append(wave)
        large[c] = [np.concatenate(done)]
        deal(lms_sorted[starts[c] : starts[c + 1]], large, False, -1)
    for c in range(size - 1, -1, -1):
        wave = np.concatenate(tail[c]) if tail[c] else lms[:0]
        done = [wave]
        while len(wave):
            wave = deal(wave, tail, True, c)
            done.append(wave)
        tail[c] = [np.concatenate(done)]
        deal(large[c][0][::-1], tail, True, -1)
    return np.concatenate([part for c in range(size) for part in (large[c][0], tail[c][0][::-1])])


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings (each up to the next LMS position), in text order; equal ones share a rank."""
    n = len(t)
    ends = np.zeros(n, np.int64)
    ends[lms[:-1]] = lms[1:]
    ends[lms[-1]] = n  # takes in the end of the text, which nothing equals
    a, b = ordered[:-1], ordered[1:]
    length = ends[a] - a + 1
    same = (length == ends[b] - b + 1) & (a != lms[-1]) & (b != lms[-1])
    active = np.flatnonzero(same)
    k = 0
    while len(active):
        differs = t[a[active] + k] != t[b[active] + k]
        same[active[differs]] = False
        k += 1
        active = active[~differs]
        active = active[length[active] > k]
    rank = np.zeros(n, np.int64)
    rank[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return rank[lms]


def _one_by_one(t: list[int], size: int) -> list[int]:
    """The same steps without arrays."""
    n = len(t)
    if n < 2:
        return list(range(n))
    small = bytearray(n)
    for i in range(n - 2, -1, -1):
        small[i] = t[i] < t[i + 1] or (t[i] == t[i + 1] and small[i + 1])
    counts = [0] * (size + 1)
    for c in t:
        counts[c + 1] += 1
    for c in range(size):
        counts[c + 1] += counts[c]
    lms = [i for i in range(1, n) if small[i] and not small[i - 1]]

    def induce(ordered: list[int]) -> list[int]:
        sa, ends = [-1] * n, counts[1:]
        for i in reversed(ordered):
            ends[t[i]] -= 1
            sa[ends[t[i]]] = i
        heads = counts[:-1]
        c = t[n - 1]
        sa[heads[c]] = n - 1
        heads[c] += 1
        for k in range(n):
            i = sa[k] - 1
            if i >= 0 and not small[i]:
                c = t[i]
                sa[heads[c]] = i
                heads[c] += 1
        ends = counts[1:]
        for k in range(n - 1, -1, -1):
            i = sa[k] - 1
            if i >= 0 and small[i]:
                c = t[i]
                ends[c] -= 1
                sa[ends[c]] = i
        return sa

    if len(lms) > 1:
        array = np.array(t)
        marks = np.zeros(n, bool)
        marks[lms] = True
        sa = np.array(induce(lms))
        ordered = sa[marks[sa]]
        names = _names(array, np.array(lms), ordered)
        top = int(names.max()) + 1
        if top < len(lms):
            ranks = _one_by_one(names.tolist(), top)
            lms = [lms[i] for i in ranks]
        else:
            lms = ordered.tolist()
    return induce(lms)


def _doubled(names: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of the reduced text, in order: groups of equal ranks are sorted by the ranks behind what they share, until none is left."""
    n = len(names)
    sa = np.argsort(names, kind="stable")
    rank, key, at, step = np.empty(n, np.int64), names[sa], np.arange(n), 1
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[sa[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]  # where the group begins
        open_ = ~new
        open_[:-1] |= ~new[1:]
        at = at[open_]
        if not len(at):
            return sa
        start = sa[at]
        behind = np.where(start + step < n, rank[np.minimum(start + step, n - 1)] + 1, 0)
        key = rank[start] * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        sa[at], key, step = start[order], key[order], 2 * step


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a text of small whole numbers, in order."""
    t = np.asarray(t)
    n = len(t)
    size = int(t.max()) + 1 if n else 0
    if n < 2 or size > SMALL:
        return np.array(_one_by_one(t.tolist(), size), dtype=np.int64)
    t = t.astype(np.uint16)
    small = classify(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        marks = np.zeros(n, bool)
        marks[lms] = True
        sa = _induce(t, small, lms, size)
        ordered = sa[marks[sa]]
        names = _names(t, lms, ordered)
        top = int(names.max()) + 1
        lms = lms[_doubled(names)] if top < len(lms) else ordered
    return _induce(t, small, lms, size)


def common_prefixes(data: bytes, sa: np.ndarray, least: int) -> np.ndarray:
    """In the order of the text, whether a suffix shares its first `least` bytes with the suffix before it in the suffix array: the
    permuted common prefixes, as far as `least`."""
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.frombuffer(data + bytes(least + 8), np.uint8)
    words = np.ndarray((n + least,), "<u8", padded, 0, (1,))
    here = np.flatnonzero(before >= 0)
    for k in [*range(0, least - 7, 8), least - 8] if least >= 8 else []:
        here = here[words[here + k] == words[before[here] + k]]
    for k in range(least) if least < 8 else []:
        here = here[padded[here + k] == padded[before[here] + k]]
    # beyond the end of the text there is nothing to share
    here = here[np.maximum(here, before[here]) + least <= n]
    out = np.zeros(n, bool)
    out[here] = True
    return out
