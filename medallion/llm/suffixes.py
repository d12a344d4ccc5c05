"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

A suffix is smaller (S) or larger (L) than the one that starts one place further right; a
leftmost S place follows an L. The substrings between leftmost S places are sorted by inducing,
get names in that order, and the string of names is sorted by the same function unless all
names differ. Their order then induces that of all suffixes in two linear passes, larger ones
from left to right and smaller ones from right to left. A pass takes a bucket of equal first symbols
at once; names are written as two digits each for that, so that there are few buckets. The recursion
ends with a short string of names, or one that digits would not shorten: its suffixes are ordered by ranks of
1, 2, 4 ... names.
"""

from __future__ import annotations

import numpy as np

#: A pass over more buckets than this would be slow.
FEW_SYMBOLS = 1024
#: Names are written as digits if the next string of names is shorter by this factor.
SHORTER = 0.9
#: Strings of names up to this length end the recursion.
SHORT = 1 << 17


def smaller(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last is larger than the empty one."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64), append=-1))
    # equal neighbours share the type of the next place that differs from its right one
    at = np.minimum.accumulate(np.where(step != 0, np.arange(n), n)[::-1])[::-1]
    return step[at] > 0


def _induced(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    sizes = np.bincount(s, minlength=symbols)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    heads, tails = starts.copy(), ends.copy()
    seeds = np.searchsorted(s[lms], np.arange(symbols + 1))
    sa, steps = np.empty(len(s), dtype=np.int64), np.arange(len(s))

    def induce(found: np.ndarray, small: bool) -> None:
        """Places before ``found``, if they are of the type, go to the next free slots of their buckets."""
        found = found[found > 0] - 1
        place(found[is_s[found] == small], small)

    def place(found: np.ndarray, small: bool) -> None:
        if not len(found):
            return
        of = s[found]
        order = of.argsort(kind="stable")
        found, of = found[order], of[order]
        last = np.empty(len(of), dtype=bool)
        last[-1] = True
        np.not_equal(of[1:], of[:-1], out=last[:-1])
        after = last.nonzero()[0] + 1
        first = np.zeros_like(after)
        first[1:] = after[:-1]
        counts, symbol = after - first, of[first]
        if small:
            sa[(tails[symbol] + first - 1).repeat(counts) - steps[: len(of)]] = found
            tails[symbol] -= counts
        else:
            sa[(heads[symbol] - first).repeat(counts) + steps[: len(of)]] = found
            heads[symbol] += counts

    used = np.flatnonzero(sizes).tolist()
    place(np.array([len(s) - 1]), False)
    for c in used:
        at = starts[c]
        while at < heads[c]:
            at, now = heads[c], sa[at : heads[c]]
            induce(now, False)
        induce(lms[seeds[c] : seeds[c + 1]], False)
    for c in reversed(used):
        at = ends[c]
        while at > tails[c]:
            at, now = tails[c], sa[tails[c] : at][::-1]
            induce(now, True)
        induce(sa[starts[c] : heads[c]][::-1], True)
    return sa


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffixes in order by ranks of runs of 1, 2, 4 ... symbols."""
    rank, size = s.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max()) + 2)
        key[: len(s) - size] += rank[size:] + 1
        order = np.argsort(key)  # equal ones get one rank in any order
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if new[-1] + 1 == len(s):
            return order
        rank[order], size = new, 2 * size


def _names(s: np.ndarray, ordered: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of the substrings ``ordered`` (sorted), equal ones alike; one ends where the next starts, inclusive."""
    sizes = ends[ordered] - ordered
    same = np.concatenate([[False], sizes[1:] == sizes[:-1]])
    active = np.flatnonzero(same)
    step = 0
    while len(active):
        left, right = ordered[active - 1] + step, ordered[active] + step
        equal = s[left] == s[right]
        same[active[~equal]] = False
        active = active[equal & (step < sizes[active])]
        step += 1
    return np.cumsum(~same) - 1


def suffix_array(s: np.ndarray, symbols: int) -> np.ndarray:
    """The starts of all suffixes of ``s`` (numbers below ``symbols``) in order; a suffix that ends first is smaller."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    if symbols > FEW_SYMBOLS:
        base = int(np.ceil(np.sqrt(symbols)))
        digits = np.stack([s // base, s % base], axis=1).astype(np.int16).ravel()
        if n <= SHORT or base > FEW_SYMBOLS or np.count_nonzero(np.diff(smaller(digits).astype(np.int8)) > 0) > SHORTER * n:
            return _doubled(s)
        found = suffix_array(digits, base)
        return found[found % 2 == 0] // 2
    is_s = smaller(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if not len(lms):
        return _induced(s, is_s, lms, symbols)
    place = np.full(n, -1, dtype=np.int64)
    place[lms] = np.arange(len(lms))
    found = _induced(s, is_s, lms[np.argsort(s[lms], kind="stable")], symbols)
    ordered = found[place[found] >= 0]
    ends = np.full(n, n - 1, dtype=np.int64)
    ends[lms[:-1]] = lms[1:]
    # the last substring ends with the text, so it equals no other
    names = _names(s, ordered, ends)
    last = np.flatnonzero(ordered == lms[-1])[0]
    if last + 1 < len(names) and names[last + 1] == names[last]:
        names[last + 1 :] += 1
    if last and names[last - 1] == names[last]:
        names[last:] += 1
    if names[-1] + 1 < len(lms):
        ordered = lms[_recursed(names, place[ordered])]
    return _induced(s, is_s, ordered, symbols)


def _recursed(names: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the string of names; ``names`` are in order, ``place`` tells where each stands.

    A name that occurs once settles its place, and no comparison goes beyond it. So of several such names in a row
    only the first takes part in the recursion.
    """
    n = len(names)
    reduced, first = np.empty(n, dtype=np.int64), np.ones(n, dtype=bool)
    reduced[place] = names
    first[1:] = names[1:] != names[:-1]
    alone = np.empty(n, dtype=bool)
    alone[place] = first & np.append(first[1:], True)
    kept = ~alone
    kept[1:] |= ~alone[:-1]
    kept = np.flatnonzero(kept)
    used = np.zeros(int(names[-1]) + 1, dtype=bool)
    used[reduced[kept]] = True
    number = np.cumsum(used) - 1
    found = kept[suffix_array(number[reduced[kept]], int(number[-1]) + 1)]
    order = place.copy()
    order[~alone[place]] = found[~alone[found]]
    return order


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place, how many symbols its suffix shares with the one before it in ``sa``.

    If the symbols before a place and before its neighbour are equal too, the place shares one
    symbol less than the place on its left; only the others are compared symbol by symbol.
    """
    n = len(s)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    derived = np.zeros(n, dtype=bool)
    derived[1:] = (before[1:] > 0) & (before[:-1] == before[1:] - 1)
    derived[1:] &= s[:-1] == s[np.maximum(before[1:] - 1, 0)]
    lengths = np.zeros(n, dtype=np.int64)
    active = np.flatnonzero(~derived & (before >= 0))
    while len(active):
        left, right = active + lengths[active], before[active] + lengths[active]
        inside = (left < n) & (right < n)
        active, left, right = active[inside], left[inside], right[inside]
        active = active[s[left] == s[right]]
        lengths[active] += 1
    source = np.maximum.accumulate(np.where(derived, -1, i))
    return np.where(derived, lengths[source] - (i - source), lengths)


def differing(s: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """True where the ``size`` bytes of ``s`` from a place on are not those from the place before it in ``places``."""
    out = np.zeros(len(places), dtype=bool)
    out[:1] = True
    if not len(places):
        return out
    step = 8 if size >= 8 else 1
    values = np.ndarray(len(s) - step + 1, f"u{step}", np.ascontiguousarray(s), strides=(1,))
    for at in {*range(0, size - step, step), size - step}:
        now = values[at:][places]
        out[1:] |= now[1:] != now[:-1]
    return out
