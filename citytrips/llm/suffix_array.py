"""Suffix arrays by induced sorting, and permuted common prefixes, with numpy.

Suffixes are smaller-type (S) or larger-type (L) than their successor. The S suffixes that follow
an L suffix (LMS) are sorted; all others are induced from them, bucket by bucket of the first
character. Within a bucket the suffixes move in waves: a wave holds those whose predecessors lie in
the same bucket, so there are as many waves as the longest run of the character.
"""

from __future__ import annotations

import numpy as np

#: Above this many different names of LMS substrings the reduced text is sorted by doubling
#: its names: passes over buckets pay only while a bucket holds many suffixes.
MOST_NAMES = 2048


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of S type; the last character is the unique smallest one."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int64)))
    # runs of equal characters take the type of the first step after them
    at = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    s_type = np.ones(n, bool)
    s_type[:-1] = step[np.minimum(following, n - 2)] > 0
    return s_type


def _induce(text: np.ndarray, s_type: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """The suffix array, given the LMS suffixes in their order (or in the order of their first
    characters, which then sorts the LMS substrings).

    L suffixes fill their buckets from the front, S suffixes from the back. A wave is what a bucket has got
    since the last one; the suffixes before it are dealt out to their buckets at once, in order."""
    n = len(text)
    chars = text.astype(np.uint16) if size <= 1 << 16 else text  # short integers are sorted by radix
    counts = np.bincount(text, minlength=size)
    stops = np.cumsum(counts)
    starts = stops - counts
    ordered = np.empty(n, np.int64)
    ahead = np.arange(n)
    larger, smaller = np.zeros(n, bool), s_type.copy()
    larger[1:], smaller[1:], smaller[0] = ~s_type[:-1], s_type[:-1], False
    used = np.flatnonzero(counts).tolist()

    def dealt(wave: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """The suffixes before a wave, if marked, by their characters; these, their counts and ranks."""
        items = wave[before[wave]] - 1
        if not len(items):
            return None
        keys = chars[items]
        order = keys.argsort(kind="stable")
        keys = keys[order]
        own = np.bincount(keys, minlength=size)
        return items[order], keys, own, ahead[:len(items)] - (own.cumsum() - own)[keys]

    seeds = lms[chars[lms].argsort(kind="stable")]
    first = [*np.searchsorted(chars[seeds], used).tolist(), len(lms)]
    head = starts.copy()
    for k, c in enumerate(used):
        done = int(starts[c])
        while done < (to := int(head[c])):
            wave, done = ordered[done:to], to
            if found := dealt(wave, larger):
                items, keys, own, rank = found
                ordered[head[keys] + rank] = items
                head += own
        if first[k] < first[k + 1] and (found := dealt(seeds[first[k]:first[k + 1]], larger)):
            items, keys, own, rank = found
            ordered[head[keys] + rank] = items
            head += own
    tail = stops.copy()
    tail[text[-1]] -= 1
    ordered[tail[text[-1]]] = n - 1
    for c in reversed(used):
        done = int(stops[c])
        while done > (to := int(tail[c])):
            wave, done = ordered[to:done][::-1], to
            if found := dealt(wave, smaller):
                items, keys, own, rank = found
                ordered[tail[keys] - 1 - rank] = items
                tail -= own
        if starts[c] < head[c] and (found := dealt(ordered[starts[c]:head[c]][::-1], smaller)):
            items, keys, own, rank = found
            ordered[tail[keys] - 1 - rank] = items
            tail -= own
    return ordered


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array of the names by doubling the length by which suffixes are sorted."""
    rank, width = names.astype(np.int64), 1
    while True:
        second = np.zeros(len(rank), np.int64)
        second[:-width] = rank[width:] + 1
        order = np.lexsort((second, rank)) if int(rank.max()) > 2**31 else np.argsort(rank * (int(rank.max()) + 2) + second, kind="stable")
        a, b = rank[order], second[order]
        fresh = np.zeros(len(rank), np.int64)
        fresh[order] = np.cumsum(np.concatenate([[0], (np.diff(a) != 0) | (np.diff(b) != 0)]))
        rank, width = fresh, width * 2
        if rank[order[-1]] == len(rank) - 1 or width >= len(rank):
            return order


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Start positions of the suffixes in their order. ``text``: integers below ``size``, the
    last one smaller than all others."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    s_type = _types(text)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if len(lms) <= 1:
        return _induce(text, s_type, lms, size)
    order = _induce(text, s_type, lms, size)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]  # LMS substrings, sorted
    # names: equal substrings (from an LMS position to the next one) get equal names
    end = np.full(n, n, np.int64)
    end[lms[:-1]] = lms[1:] + 1
    same = _equal_spans(text, order[:-1], order[1:], end)
    name = np.zeros(n, np.int64)
    name[order] = np.cumsum(np.concatenate([[0], ~same]))
    reduced = name[lms]
    names = int(reduced.max()) + 1
    if names < len(lms):
        order = lms[suffix_array(reduced, names) if names <= MOST_NAMES else _doubled(reduced)]
    return _induce(text, s_type, order, size)


def _equal_spans(text: np.ndarray, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether text[a:end[a]] equals text[b:end[b]], for many pairs."""
    length = end[a] - a
    same = length == end[b] - b
    live = np.flatnonzero(same)
    for k in range(int(length[live].max(initial=0))):
        live = live[length[live] > k]
        if not len(live):
            break
        differ = text[a[live] + k] != text[b[live] + k]
        same[live[differ]] = False
        live = live[~differ]
    return same


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, the length of the common prefix of its suffix with the one before it in
    the suffix array (0 for the first).

    Only irreducible values, where the characters before the two suffixes differ, are counted
    out; from one position to the next every other value falls by one.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    open_ = before >= 0
    reducible = open_.copy()
    reducible[0] = False
    inner = np.flatnonzero(open_[1:] & (before[1:] > 0)) + 1
    reducible[:] = False
    reducible[inner] = text[inner - 1] == text[before[inner] - 1]
    # eight characters at a time, as far as they fit in bytes; the remainder one by one
    found = np.zeros(n, np.int64)
    live = np.flatnonzero(open_ & ~reducible)
    padded = np.concatenate([text.astype(np.uint64), np.arange(8, dtype=np.uint64)])
    words = sum(padded[k:k + n] * np.uint64(pow(65539, 2 * k + 1, 2**64)) for k in range(4))
    while len(live):
        i, j = live + found[live], before[live] + found[live]
        inside = np.maximum(i, j) + 4 < n
        equal = np.zeros(len(live), bool)
        equal[inside] = words[i[inside]] == words[j[inside]]
        # a hash may agree by chance: the characters decide
        for k in range(4):
            some = np.flatnonzero(equal)
            equal[some] = text[i[some] + k] == text[j[some] + k]
        found[live[equal]] += 4
        live = live[equal]
    live = np.flatnonzero(open_ & ~reducible)
    for _ in range(4):
        i, j = live + found[live], before[live] + found[live]
        inside = np.maximum(i, j) < n
        live, i, j = live[inside], i[inside], j[inside]
        equal = text[i] == text[j]
        live = live[equal]
        found[live] += 1
    # the last irreducible position at or before each one
    base = np.maximum.accumulate(np.where(reducible, 0, at))
    return np.where(reducible, found[base] - (at - base), found)
