"""Suffix arrays by induced sorting, and permuted common prefixes, in NumPy.

Suffixes are classified, the leftmost-smaller substrings are sorted by an induced pass
and named, the string of their names is sorted the same way (recursively, until the names
differ), and the order of all suffixes is induced from theirs.

Over bytes, the induced passes walk the buckets of the alphabet; within a bucket, all
suffixes whose predecessors fall into other buckets are dealt at once, so a pass is a
linear amount of work in a few array operations per bucket (and one more per length of
a run of one symbol).  Over names, whose buckets are small, a pass is a scan.
"""

from __future__ import annotations

import numpy as np

STRIDE = 1024
DENSE = 256   # suffixes per bucket from which buckets are dealt as arrays


def smaller_type(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (the last, least one is)."""
    out = np.ones(len(s), bool)
    ends = np.flatnonzero(s[1:] != s[:-1])
    if len(ends):
        sizes = np.diff(np.concatenate([[-1], ends]))
        out[:ends[-1] + 1] = np.repeat(s[ends] < s[ends + 1], sizes)
    return out


def _deal(place: np.ndarray, symbol: np.ndarray, pending: list[list[np.ndarray]]) -> None:
    """Append places to the buckets of their symbols, in order."""
    if not len(place):
        return
    order = np.argsort(symbol, kind="stable")
    symbol, place = symbol[order], place[order]
    cut = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
    lo = 0
    for hi in [*cut.tolist(), len(place)]:
        pending[symbol[lo]].append(place[lo:hi])
        lo = hi


def _induce(s: np.ndarray, small: np.ndarray, leftmost: np.ndarray, sigma: int) -> np.ndarray:
    """The order of all suffixes that follows from the order of ``leftmost``."""
    none = np.empty(0, np.int64)
    join = lambda parts: parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else none
    order = np.argsort(s[leftmost], kind="stable")
    seeds = leftmost[order]
    at = np.searchsorted(s[seeds], np.arange(sigma + 1))
    pending: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    larger: list[np.ndarray] = [none] * sigma
    for c in range(sigma):                       # left to right: suffixes of larger type
        done, cur = [], join(pending[c])
        while len(cur):
            done.append(cur)
            p = cur[cur > 0] - 1
            p = p[~small[p]]
            k = s[p]
            same = k == c
            _deal(p[~same], k[~same], pending)
            cur = p[same]
        larger[c] = join(done)
        p = seeds[at[c]:at[c + 1]] - 1
        p = p[p >= 0]
        _deal(p, s[p], pending)
    pending = [[] for _ in range(sigma)]
    out: list[np.ndarray] = [none] * sigma
    for c in range(sigma - 1, -1, -1):           # right to left: suffixes of smaller type
        done, cur = [], join(pending[c])
        while len(cur):
            done.append(cur)
            p = cur[cur > 0] - 1
            p = p[small[p]]
            k = s[p]
            same = k == c
            _deal(p[~same], k[~same], pending)
            cur = p[same]
        l = larger[c][::-1]
        p = l[l > 0] - 1
        p = p[small[p]]
        _deal(p, s[p], pending)
        out[c] = np.concatenate([larger[c], join(done)[::-1]])
    out[0] = np.array([len(s) - 1])
    return np.concatenate(out)


def _names(s: np.ndarray, leftmost: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Names of the leftmost-smaller substrings, by text place; equal ones alike."""
    size = np.empty(len(s), np.int64)
    size[leftmost] = np.diff(np.append(leftmost, len(s) - 1))
    a, b = ranked[:-1], ranked[1:]
    differ = size[a] != size[b]
    active = np.flatnonzero(~differ)
    step = 0
    while len(active):
        x, y = a[active], b[active]
        bad = s[x + step] != s[y + step]
        differ[active[bad]] = True
        active = active[~bad]
        active = active[size[a[active]] > step]   # the end symbol counts as well
        step += 1
    name = np.empty(len(s), np.int64)
    name[ranked] = np.concatenate([[0], np.cumsum(differ)])
    return name[leftmost]


def _induce_sparse(s: np.ndarray, small: np.ndarray, leftmost: np.ndarray,
                   sigma: int) -> np.ndarray:
    """``_induce`` for an alphabet so large that its buckets hold a few suffixes each: buckets
    by counting, one scan from the left and one from the right."""
    n = len(s)
    count = np.bincount(s, minlength=sigma)
    ends = np.cumsum(count)
    seeds = leftmost[np.argsort(s[leftmost], kind="stable")]
    own = np.bincount(s[seeds], minlength=sigma)
    sa = np.full(n, -1, np.int64)
    sa[ends[s[seeds]] - np.cumsum(own)[s[seeds]] + np.arange(len(seeds))] = seeds
    order = sa.tolist()
    # The symbol before each place, where that suffix is of the scan's type; else -1 (an
    # empty slot, -1, looks at the extra last entry).
    before = np.concatenate([[-1], s[:-1].astype(np.int64), [-1]])
    is_small = np.concatenate([[False], small[:-1], [False]])
    symbol = np.where(is_small, -1, before).tolist()
    at = (ends - count).tolist()
    for j in order:                              # filled further on while it is read
        c = symbol[j]
        if c >= 0:
            p = at[c]
            order[p] = j - 1
            at[c] = p + 1
    symbol = np.where(is_small, before, -1).tolist()
    at = ends.tolist()
    for j in reversed(order):
        c = symbol[j]
        if c >= 0:
            p = at[c] - 1
            order[p] = j - 1
            at[c] = p
    return np.array(order, np.int64)


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of ``s``, whose last symbol is 0 and occurs only there."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    small = smaller_type(s)
    edge = small.copy()
    edge[0] = False
    edge[1:] &= ~small[:-1]
    leftmost = np.flatnonzero(edge)
    induce = _induce if n >= DENSE * sigma else _induce_sparse
    order = induce(s, small, leftmost, sigma)
    ranked = order[edge[order]]
    names = _names(s, leftmost, ranked)
    top = int(names.max()) + 1
    sort = np.argsort(names) if top == len(leftmost) else suffix_array(names, top)
    return induce(s, small, leftmost[sort], sigma)


def permuted_lcp(s: np.ndarray, sa: np.ndarray,
                 enough: int) -> tuple[np.ndarray, np.ndarray]:
    """(predecessor in the order, common prefix with it), by text place.

    Only where the symbols before both differ (and every ``STRIDE`` places) is a prefix
    compared; at the next place it is shorter by one.  Prefixes are exact below
    ``enough``, and at least ``enough`` where they are as long.
    """
    n = len(s)
    phi = np.empty(n, np.int64)
    phi[sa[0]] = -1
    phi[sa[1:]] = sa[:-1]
    fresh = np.ones(n, bool)
    i = np.arange(1, n)
    ok = phi[1:] > 0
    fresh[1:][ok] = s[i[ok] - 1] != s[phi[1:][ok] - 1]
    fresh[::STRIDE] = True
    starts = np.flatnonzero(fresh)
    lcp = np.zeros(len(starts), np.int64)
    live = np.flatnonzero(phi[starts] >= 0)
    padded = np.concatenate([s.astype(np.uint16), np.zeros(4, np.uint16)])
    word = np.zeros(n, np.uint64)                 # four symbols at a time
    for j in range(4):
        word |= padded[j:j + n].astype(np.uint64) << np.uint64(16 * j)
    while len(live):
        x, y = starts[live] + lcp[live], phi[starts[live]] + lcp[live]
        diff = word[x] ^ word[y]
        stop = diff != 0
        part = np.zeros(len(live), np.int64)
        for j in (1, 2, 3):
            part += (diff & np.uint64((1 << (16 * j)) - 1)) == 0
        lcp[live] += np.where(stop, part, 4)
        live = live[~stop]
        end = np.maximum(starts[live], phi[starts[live]]) + lcp[live]
        live = live[(end < n) & (lcp[live] < enough + STRIDE)]
    last = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    which = np.searchsorted(starts, last)
    return phi, lcp[which] - (np.arange(n) - last)
