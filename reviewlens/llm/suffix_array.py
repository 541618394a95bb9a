"""Suffix arrays by induced sorting, and permuted common prefixes.

``suffix_array`` classifies suffixes, sorts the leftmost-smaller (LMS) substrings by
inducing, names them and recurses on the names, then induces the whole array from the
sorted LMS suffixes; linear in the text.  Induction over a small alphabet goes bucket by
bucket in numpy: all suffixes that a bucket induces are appended to their buckets at once.
Over the large alphabets of the recursion it goes suffix by suffix.

``common_prefixes`` gives, in text order, how long the common prefix of each suffix and
its predecessor in the array is.  Only the positions where the text before the two differs
are compared; every other value is its left neighbour's less one.
"""

from __future__ import annotations

import numpy as np

#: Texts with this many symbols a kind are induced bucket by bucket.
BUCKET = 64


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of symbols ``0 <= s``; a suffix that is a prefix of another sorts before it."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    text = np.asarray(text, np.int64)
    # type of each suffix: smaller (S) or larger (L) than the next one; the end counts as the smallest
    differs = np.flatnonzero(text[:-1] != text[1:])
    smaller = np.zeros(n, bool)
    if len(differs):
        upto = np.searchsorted(differs, np.arange(differs[-1] + 1))
        smaller[: differs[-1] + 1] = (text[:-1] < text[1:])[differs[upto]]
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sizes = np.bincount(text)
    small = len(sizes) * BUCKET <= n
    induce = _induce_buckets if small else _induce_single
    if not len(lms):
        return induce(text, smaller, lms, sizes)
    first = induce(text, smaller, lms, sizes)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = first[is_lms[first]]
    names, count = _name(text, lms, ordered)
    if count < len(lms):
        order = suffix_array(names)
    else:
        order = np.empty(len(lms), np.int64)
        order[names] = np.arange(len(lms))
    return induce(text, smaller, lms[order], sizes)


def _name(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the LMS substrings in text order (equal substrings, equal names), and how many names."""
    n = len(text)
    rank = np.empty(n, np.int64)
    rank[lms] = np.arange(len(lms))
    length = np.append(lms[1:] - lms[:-1] + 1, n - lms[-1])  # to the next LMS position, inclusive
    at = rank[ordered]
    a, b = ordered[:-1], ordered[1:]
    same = length[at[:-1]] == length[at[1:]]
    same &= (at[:-1] != len(lms) - 1) & (at[1:] != len(lms) - 1)  # the last one ends with the text
    live, offset = np.flatnonzero(same), 0
    while len(live):
        equal = text[a[live] + offset] == text[b[live] + offset]
        same[live[~equal]] = False
        offset += 1
        live = live[equal]
        live = live[length[at[live]] > offset]
    value = np.concatenate([[0], np.cumsum(~same)])
    names = np.empty(len(lms), np.int64)
    names[at] = value
    return names, int(value[-1]) + 1


def _ends(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    tails = np.cumsum(sizes)
    return tails - sizes, tails


def _induce_buckets(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffix array induced from ``lms`` (in order), one numpy step a bucket and run."""
    n, kinds = len(text), len(sizes)
    heads, tails = _ends(sizes)
    out = np.full(n, -1, np.int64)
    # LMS suffixes at the ends of their buckets, in order
    kind = text[lms]
    order = np.argsort(kind, kind="stable")
    counts = np.bincount(kind, minlength=kinds)
    lms_from = tails - counts
    within = np.arange(len(lms)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[np.repeat(lms_from, counts) + within] = lms[order]

    fill = heads.copy()

    def append(found: np.ndarray, step: int, at: np.ndarray) -> None:
        """Add suffixes, in order, to their buckets from ``at`` on in the direction ``step``."""
        kind = text[found]
        order = np.argsort(kind, kind="stable")
        counts = np.bincount(kind, minlength=kinds)
        used = np.flatnonzero(counts)
        within = np.arange(len(found)) - np.repeat((np.cumsum(counts) - counts)[used], counts[used])
        out[at[kind[order]] + step * within] = found[order]
        at[used] += step * counts[used]

    # larger suffixes, left to right; the last one is induced by the end of the text
    if not smaller[n - 1]:
        append(np.array([n - 1]), 1, fill)
    for c in range(kinds):
        low = heads[c]
        while low < fill[c]:  # larger suffixes of this bucket, which may add to it
            high = fill[c]
            found = out[low:high] - 1
            found = found[found >= 0]
            append(found[~smaller[found]], 1, fill)
            low = high
        found = out[lms_from[c] : tails[c]] - 1
        found = found[found >= 0]
        append(found[~smaller[found]], 1, fill)
    # smaller suffixes, right to left; they replace the LMS suffixes at the ends
    end = tails - 1
    larger_to = fill
    for c in range(kinds - 1, -1, -1):
        high = tails[c] - 1
        while high > end[c]:
            low = end[c]
            found = out[low + 1 : high + 1][::-1] - 1
            found = found[found >= 0]
            append(found[smaller[found]], -1, end)
            high = low
        found = out[heads[c] : larger_to[c]][::-1] - 1
        found = found[found >= 0]
        append(found[smaller[found]], -1, end)
    return out


def _induce_single(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffix array induced from ``lms`` (in order), suffix by suffix."""
    n = len(text)
    heads, tails = _ends(sizes)
    s, is_small = text.tolist(), smaller.tolist()
    out = [-1] * n
    end = tails.tolist()
    for i in lms[::-1].tolist():
        c = s[i]
        end[c] -= 1
        out[end[c]] = i
    fill = heads.tolist()
    if not is_small[n - 1]:
        c = s[n - 1]
        out[fill[c]] = n - 1
        fill[c] += 1
    for r in range(n):
        j = out[r] - 1
        if j >= 0 and not is_small[j]:
            c = s[j]
            out[fill[c]] = j
            fill[c] += 1
    end = tails.tolist()
    for r in range(n - 1, -1, -1):
        j = out[r] - 1
        if j >= 0 and is_small[j]:
            c = s[j]
            end[c] -= 1
            out[end[c]] = j
    return np.array(out, np.int64)


def common_prefixes(text: np.ndarray, array: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(predecessor in the array, length of the common prefix with it) of each suffix, in text order.

    Lengths count up to ``room`` (symbols to the end of the suffix's own string).  The
    predecessor of the first suffix is -1.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    own = np.ones(n, bool)  # compared, not derived
    i = np.flatnonzero((before > 0) & (np.arange(n) > 0))
    own[i] = text[i - 1] != text[before[i] - 1]
    own[1:] |= room[1:] != room[:-1] - 1
    length = np.zeros(n, np.int64)
    live, offset = np.flatnonzero(own & (before >= 0)), 0
    other = before[live]
    most = np.minimum(room[live], n - other)
    while len(live):
        go = offset < most
        go[go] = text[live[go] + offset] == text[other[go] + offset]
        length[live[~go]] = offset
        live, other, most = live[go], other[go], most[go]
        offset += 1
    anchor = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return before, np.maximum(0, length[anchor] - (np.arange(n) - anchor))
