"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified, leftmost-smaller substrings are sorted by induction and
named, the shorter string of names is sorted, and its order induces the array of
the text. Induction works on whole buckets as numpy arrays. The string of names
has too large an alphabet for that, so its recursion doubles ranks instead.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True for suffixes that are smaller than the next one; the last is the sentinel."""
    n = len(t)
    out = np.ones(n, bool)
    if n > 1:
        differs = np.where(t[:-1] != t[1:], np.arange(n - 1), n)
        nearest = np.minimum.accumulate(differs[::-1])[::-1]
        out[:-1] = t[nearest] < t[nearest + 1]
    return out


def _along_runs(bucket: np.ndarray, run: np.ndarray) -> np.ndarray:
    """A bucket's suffixes, and those that begin before them in the same run of one character: all by one character, then by two, and so on."""
    before = bucket - run[bucket]
    total = int(before.sum())
    if not total:
        return bucket
    upto = np.cumsum(before)
    back = np.arange(1, total + 1) - np.repeat(upto - before, before)
    return np.concatenate((bucket, (np.repeat(bucket, before) - back)[np.argsort(back, kind="stable")]))


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """The suffix array that the given order of leftmost-smaller suffixes induces."""
    size_l = np.bincount(t[~small], minlength=sigma)
    size_s = np.bincount(t[small], minlength=sigma)
    from_l, from_s = np.append(0, np.cumsum(size_l)), np.append(0, np.cumsum(size_s))
    large, less = np.empty(from_l[-1], np.int64), np.empty(from_s[-1], np.int64)
    chars = t[lms]
    by_char = lms[np.argsort(chars, kind="stable")]
    from_m = np.append(0, np.cumsum(np.bincount(chars, minlength=sigma)))
    head, tail = from_l[:-1].copy(), from_s[1:].copy()
    begins = np.append(True, t[1:] != t[:-1])
    run = np.maximum.accumulate(np.where(begins, np.arange(len(t)), 0))  # where the run of one character that holds a place begins
    # The character of a place that induction reaches from the next one, else ``sigma``: within a run, _along_runs does. The last place stands for that before the first.
    ends = np.append(begins[1:], False)
    char_l = np.where(ends & ~small, t, np.uint16(sigma))
    char_s = np.where(ends & small, t, np.uint16(sigma))

    def scatter(now: np.ndarray, char: np.ndarray, out: np.ndarray, edge: np.ndarray, step: int) -> None:
        c = char[now - 1]
        live = np.flatnonzero(c != sigma)
        if not len(live):
            return
        c = c[live]
        order = np.argsort(c, kind="stable")  # 16 bits sort by radix
        count = np.bincount(c, minlength=sigma)
        # Of one character, the first goes to the bucket's edge and the others follow.
        at = (edge - (step < 0) - step * (np.cumsum(count) - count))[c[order]]
        out[at + step * np.arange(len(c))] = now[live[order]] - 1
        edge += step * count

    for c in np.flatnonzero(size_l + np.diff(from_m)).tolist():
        now = _along_runs(large[from_l[c] : head[c]], run)
        head[c] = from_l[c] + len(now)
        large[from_l[c] : head[c]] = now
        scatter(now, char_l, large, head, 1)
        scatter(by_char[from_m[c] : from_m[c + 1]], char_l, large, head, 1)
    less[0] = len(t) - 1  # the sentinel
    for c in np.flatnonzero(size_s + size_l)[::-1].tolist():
        end = from_s[c + 1]
        now = _along_runs(less[tail[c] : end][::-1], run)
        tail[c] = end - len(now)
        less[tail[c] : end] = now[::-1]
        scatter(now, char_s, less, tail, -1)
        scatter(large[from_l[c] : from_l[c + 1]][::-1], char_s, less, tail, -1)
    out = np.empty(len(t), np.int64)
    start = from_l[:-1] + from_s[:-1]
    out[np.arange(len(large)) + np.repeat(from_s[:-1], size_l)] = large
    out[np.arange(len(less)) + np.repeat(start + size_l - from_s[:-1], size_s)] = less
    return out


def _sort_names(names: np.ndarray) -> np.ndarray:
    """The suffix array of a string of ranks: pairs of ranks double the sorted length until all suffixes differ."""
    n, rank, step = len(names), names, 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] + 1
        pair = rank * (n + 1) + ahead
        order = np.argsort(pair)
        pair = pair[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.append(0, np.cumsum(pair[1:] != pair[:-1]))
        if fresh[order[-1]] == n - 1:
            return order
        rank, step = fresh, step * 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of a byte array."""
    t = np.append(text.astype(np.uint16) + 1, np.uint16(0))
    small = _types(t)
    is_lms = np.zeros(len(t), bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    order = _induce(t, small, lms, 257)
    order = order[is_lms[order]]
    # Name the sorted substrings: equal ones are neighbours.
    end = np.empty(len(t), np.int64)
    end[lms] = np.append(lms[1:], len(t) - 1)
    a, b = order[:-1], order[1:]
    size = end[b] - b
    same = size == end[a] - a
    # The substrings overlap by a character, so all that are compared are about as long as the text.
    pairs = np.flatnonzero(same)
    length = size[pairs] + 1
    step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    equal = t[np.repeat(a[pairs], length) + step] == t[np.repeat(b[pairs], length) + step]
    if len(pairs):
        same[pairs] = np.logical_and.reduceat(equal, np.cumsum(length) - length)
    # The last bytes' types need no look: both substrings end where one begins.
    rank = np.append(0, np.cumsum(~same))
    if rank[-1] + 1 < len(lms):
        names = np.empty(len(t), np.int64)
        names[order] = rank
        order = lms[_sort_names(names[lms])]
    return _induce(t, small, order, 257)[1:]


def permuted_prefixes(text: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """For each text position, the common prefix with the suffix before it in the array, counted up to ``cap``."""
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    padded = np.append(text, np.zeros(cap + 8, np.uint8))
    words = np.ndarray((n + cap,), np.uint64, padded, 0, (1,))
    out = np.zeros(n, np.int64)
    live = np.flatnonzero(phi >= 0)
    for step in range(0, cap, 8):
        differ = words[live + step] ^ words[phi[live] + step]
        equal = differ == 0
        stop = differ[~equal]
        low = (stop & (~stop + np.uint64(1))).astype(np.float64)
        out[live[~equal]] += (np.log2(low) // 8).astype(np.int64)
        live = live[equal]
        out[live] += 8
    # No common prefix reaches over the end of the text.
    return np.minimum(np.minimum(out, cap), n - np.maximum(np.arange(n), phi))
