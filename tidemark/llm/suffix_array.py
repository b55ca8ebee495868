"""Suffix arrays by induced sorting: bytes one bucket of first symbols at a time in numpy, the
shorter texts of names below them one suffix at a time."""

from __future__ import annotations

import numpy as np


def classify(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The end is smaller than any symbol,
    so the last suffix is larger."""
    n = len(t)
    step = np.sign(np.diff(t.astype(np.int64), append=-1))
    at = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(at[::-1])[::-1]  # where the next change of symbol is
    return step[following] > 0


def induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The order of all suffixes induced from an order of the leftmost-smaller ones (seeds):
    larger ones on a scan of the buckets upwards, smaller ones on a scan downwards. What a
    bucket induces in itself comes in waves, one a repeat of its symbol."""
    n = len(t)
    top = int(t.max()) + 1
    if top > 256:
        return _induce_names(t, small, seeds, top)
    first = t[seeds]
    by = np.argsort(first, kind="stable")
    cuts = np.searchsorted(first[by], np.arange(top + 1))
    seeded = [seeds[by[a:b]] for a, b in zip(cuts, cuts[1:])]
    empty = np.zeros(0, np.int64)

    def deal(waiting: list[list[np.ndarray]], found: np.ndarray) -> None:
        c = t[found]
        by = np.argsort(c, kind="stable")
        c = c[by]
        starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        for a, b in zip(starts, [*starts[1:], len(c)]):
            waiting[c[a]].append(found[by[a:b]])

    def before(placed: np.ndarray, want_small: bool) -> np.ndarray:
        p = placed[placed > 0] - 1
        return p[small[p] == want_small]

    large: list[np.ndarray] = [empty] * top
    waiting: list[list[np.ndarray]] = [[] for _ in range(top)]
    waiting[t[n - 1]].append(np.array([n - 1]))
    for c in range(top):
        wave = np.concatenate(waiting[c]) if waiting[c] else empty
        waves, onward = [], []
        while len(wave):
            waves.append(wave)
            p = before(wave, False)
            same = t[p] == c
            onward.append(p[~same])
            wave = p[same]
        large[c] = np.concatenate(waves) if waves else empty
        onward.append(before(seeded[c], False))
        found = np.concatenate(onward)
        if len(found):
            deal(waiting, found)
    little: list[np.ndarray] = [empty] * top
    waiting = [[] for _ in range(top)]
    for c in range(top - 1, -1, -1):
        wave = np.concatenate(waiting[c]) if waiting[c] else empty
        waves, onward = [], []
        while len(wave):
            waves.append(wave)
            p = before(wave, True)
            same = t[p] == c
            onward.append(p[~same])
            wave = p[same]
        little[c] = np.concatenate(waves)[::-1] if waves else empty
        onward.append(before(large[c][::-1], True))
        found = np.concatenate(onward)
        if len(found):
            deal(waiting, found)
    return np.concatenate([x for c in range(top) for x in (large[c], little[c])])


def _induce_names(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, top: int) -> np.ndarray:
    """induce() for large alphabets, where most buckets hold a few suffixes."""
    counts = np.bincount(t, minlength=top)
    ends = np.cumsum(counts)
    text, is_small, out = t.tolist(), small.tolist(), [-1] * len(t)
    tail, head = ends.tolist(), (ends - counts).tolist()
    for i in reversed(seeds.tolist()):
        c = text[i]
        tail[c] -= 1
        out[tail[c]] = i
    c = text[-1]
    out[head[c]] = len(t) - 1
    head[c] += 1
    for i in out:  # grows ahead of the scan
        if i > 0 and not is_small[i - 1]:
            c = text[i - 1]
            out[head[c]] = i - 1
            head[c] += 1
    tail = ends.tolist()
    for at in range(len(t) - 1, -1, -1):
        i = out[at]
        if i > 0 and is_small[i - 1]:
            c = text[i - 1]
            tail[c] -= 1
            out[tail[c]] = i - 1
    return np.array(out)


def _words(t: np.ndarray) -> tuple[np.ndarray, int]:
    """Symbols from each place on as one integer (zeros past the end), and how many: eight bytes,
    or one name."""
    if t.dtype != np.uint8:
        return t.astype(np.uint64), 1
    padded = np.concatenate([t.astype(np.uint64), np.zeros(8, np.uint64)])
    out = np.zeros(len(t), np.uint64)
    for i in range(8):
        out |= padded[i : i + len(t)] << np.uint64(8 * i)
    return out, 8


def common_prefix(t: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many symbols (at most `most`) the suffixes at a and b share, a word at a step."""
    words, size = _words(t)
    n = len(words)
    out = np.zeros(len(a), np.int64)
    todo = np.arange(len(a))
    while len(todo):
        i, j = a[todo] + out[todo], b[todo] + out[todo]
        ok = (i < n) & (j < n) & (out[todo] < most)
        todo, i, j = todo[ok], i[ok], j[ok]
        x = words[i] ^ words[j]
        low = (x & (~x + np.uint64(1))).astype(np.float64)
        same = np.where(x == 0, size, (np.log2(np.maximum(low, 1)) // 8).astype(np.int64) if size > 1 else 0)
        out[todo] += np.minimum(same, n - np.maximum(i, j))
        todo = todo[x == 0]
    return np.minimum(out, most)


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Start places of the suffixes of t (bytes, or names from 0 on) in order."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    small = classify(t)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1  # leftmost smaller suffixes
    if len(starts) > 1:
        # their substrings, up to the next one, are sorted by one induction and then named
        order = induce(t, small, starts)
        is_start = np.zeros(n, bool)
        is_start[starts] = True
        order = order[is_start[order]]
        length = np.zeros(n, np.int64)
        length[starts] = np.diff(starts, append=n) + 1
        length[starts[-1]] = n + 2  # reaches the end: unlike any other
        a, b = order[:-1], order[1:]
        same = np.zeros(len(a), bool)
        at = np.flatnonzero(length[a] == length[b])
        same[at] = common_prefix(t, a[at], b[at], int(length[a[at]].max()) if len(at) else 0) >= length[a[at]]
        name = np.zeros(n, np.int64)
        name[order] = np.r_[0, np.cumsum(~same)]
        # names that all differ give the order; else the shorter text of names is sorted the same way
        starts = order if not same.any() else starts[_sorted_names(name[starts])]
    return induce(t, small, starts)


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """The suffixes of a text of names in order. A name that occurs once decides any comparison
    that reaches it, so only names that repeat, and what follows them, are sorted."""
    once = np.bincount(names)[names] == 1
    kept = np.flatnonzero(~once | np.r_[False, ~once[:-1]])
    dense = np.zeros(int(names.max()) + 1, np.int64)
    dense[names[kept]] = 1
    order = kept[suffix_array(np.cumsum(dense)[names[kept]] - 1)]
    order = np.r_[order[~once[order]], np.flatnonzero(once)]
    return order[np.argsort(names[order], kind="stable")]


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each place the symbols (at most `most`) its suffix shares with its predecessor in
    the suffix array. Only places whose preceding symbol differs from the predecessor's are
    compared; any other has one less than the place before it."""
    n = len(t)
    if not n:
        return np.zeros(0, np.int64)
    prev = np.full(n, -1)
    prev[sa[1:]] = sa[:-1]
    i = np.arange(n)
    reducible = (i > 0) & (prev > 0)
    reducible[reducible] = t[i[reducible] - 1] == t[prev[reducible] - 1]
    starts = np.flatnonzero(~reducible)
    known = np.zeros(n, np.int64)
    has = starts[prev[starts] >= 0]
    known[has] = common_prefix(t, has, prev[has], n)
    at = np.maximum.accumulate(np.where(~reducible, i, 0))
    return np.minimum(np.maximum(known[at] - (i - at), 0), most)
