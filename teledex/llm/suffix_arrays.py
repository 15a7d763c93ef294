"""Suffix arrays by induced sorting, and permuted longest common prefixes, in numpy.

Suffixes are classed as smaller (S) or larger (L) than the next one. Leftmost S-type
substrings (LMS) are sorted by inducing from their first letters, named, and the string
of names is sorted by recursion where names repeat. Sorted LMS suffixes induce the L
types, and those the S types. Over bytes, a bucket's entries are induced together by
array operations; strings of names have too many letters for that and use plain loops.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True for S types. The last letter must be the unique smallest."""
    n = len(s)
    smaller = np.zeros(n, bool)
    smaller[-1] = True
    differs = np.flatnonzero(s[1:] != s[:-1])
    # Within a run of equal letters the type is that at the run's end.
    ends = np.concatenate([differs, [n - 1]])
    kinds = np.concatenate([s[differs] < s[differs + 1], [True]])
    return np.repeat(kinds, np.diff(np.concatenate([[-1], ends])))


def _induce_bytes(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes induced from the LMS ones in the given order; bucket by bucket."""
    letters = len(sizes)
    s = s.astype(np.int16)  # numpy's stable sort of short integers is linear
    seeds: list[np.ndarray] = [np.zeros(0, np.int64)] * letters
    order = np.argsort(s[lms], kind="stable")
    for chunk in np.split(lms[order], np.flatnonzero(np.diff(s[lms[order]])) + 1) if len(lms) else []:
        seeds[s[chunk[0]]] = chunk

    def sweep(buckets: range, start: list[list[np.ndarray]], want: bool) -> list[list[np.ndarray]]:
        got: list[list[np.ndarray]] = [[] for _ in range(letters)]
        for c in buckets:
            waves = list(got[c])
            later = start[c]
            done: list[np.ndarray] = []
            while waves or later:
                wave = np.concatenate(waves) if waves else np.concatenate(later)
                if not waves:
                    later = []
                else:
                    done.append(wave)
                waves = []
                before = wave - 1
                before = before[before >= 0]
                before = before[small[before] != want]
                if not len(before):
                    continue
                first = s[before]
                by = np.argsort(first, kind="stable")
                before, first = before[by], first[by]
                for part in np.split(before, np.flatnonzero(np.diff(first)) + 1):
                    d = int(s[part[0]])
                    if d == c:
                        waves.append(part)
                    else:
                        got[d].append(part)
            got[c] = done
        return got

    # L types from the front: a bucket's L entries, then its LMS seeds.
    large = sweep(range(letters), [[x] if len(x) else [] for x in seeds], True)
    # S types from the back, in reverse order; then a bucket's L entries, reversed.
    back = [[np.concatenate(x)[::-1]] if x else [] for x in large]
    tail = sweep(range(letters - 1, -1, -1), back, False)
    out = [np.array([len(s) - 1])]  # the only suffix of letter 0
    for c in range(1, letters):
        out += large[c]
        if tail[c]:
            out.append(np.concatenate(tail[c])[::-1])
    return np.concatenate(out)


def _induce_names(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same for strings of many letters, entry by entry."""
    n = len(s)
    text, kind = s.tolist(), small.tolist()
    heads = (np.cumsum(sizes) - sizes).tolist()
    tails = (np.cumsum(sizes) - 1).tolist()
    out = [-1] * n
    at = list(tails)
    for i in reversed(lms.tolist()):
        c = text[i]
        out[at[c]] = i
        at[c] -= 1
    at = heads
    for k in range(n):
        i = out[k] - 1
        if i >= 0 and not kind[i]:
            c = text[i]
            out[at[c]] = i
            at[c] += 1
    at = tails
    for k in range(n - 1, -1, -1):
        i = out[k] - 1
        if i >= 0 and kind[i]:
            c = text[i]
            out[at[c]] = i
            at[c] -= 1
    return np.array(out, np.int64)


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names (from 0, in order) of LMS substrings, by the place of their start."""
    ends = np.empty(len(s), np.int64)
    ends[lms] = np.concatenate([lms[1:], [len(s) - 1]])
    a, b = ordered[:-1], ordered[1:]
    length = ends[b] - b
    same = (ends[a] - a) == length
    active = np.flatnonzero(same)
    step = 0
    while len(active):
        equal = s[a[active] + step] == s[b[active] + step]
        same[active[~equal]] = False
        active = active[equal & (length[active] > step)]
        step += 1
    names = np.empty(len(s), np.int64)
    names[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return names[lms]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The suffix array of integers from 0; the last must be 0 and the only one."""
    if len(s) == 1:
        return np.zeros(1, np.int64)
    s = np.asarray(s, np.int64)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sizes = np.bincount(s)
    induce = _induce_bytes if len(sizes) <= 1024 else _induce_names
    ordered = induce(s, small, lms, sizes)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    ordered = ordered[is_lms[ordered]]
    names = _names(s, lms, ordered)
    if names.max() + 1 < len(lms):
        ordered = lms[suffix_array(names)]
    return induce(s, small, ordered, sizes)


def permuted_lcp(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """By text place, the common prefix with the suffix before it in the array.

    Only places whose left letter differs from their predecessor's are compared; at all
    others the value is one less than at the place before.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    left, own = s[np.maximum(before - 1, 0)], s[place - 1]
    fresh = (before <= 0) | (place == 0) | (left != own)
    starts = np.flatnonzero(fresh)
    value = np.zeros(n, np.int64)
    active = starts[before[starts] >= 0]
    length = np.zeros(n, np.int64)
    while len(active):
        a, b = active + length[active], before[active] + length[active]
        inside = (a < n) & (b < n)
        equal = np.zeros(len(active), bool)
        equal[inside] = s[a[inside]] == s[b[inside]]
        active = active[equal]
        length[active] += 1
    value[starts] = length[starts]
    last = np.maximum.accumulate(np.where(fresh, place, 0))
    return np.maximum(value[last] - (place - last), 0)
