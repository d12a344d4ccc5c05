"""Words of many texts at once as 64-bit hashes, in numpy on the UTF-8 bytes.

A word is a run of bytes that a table of 256 flags calls word bytes. UTF-8 keeps ASCII
bytes apart from all others, so classes that name ASCII characters only are exact on bytes.
A hash adds a random value for each byte times a power of an odd base, taken modulo 2**64,
and mixes the sum; A-Z count as a-z.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from medallion.llm.store import binary

U64 = np.uint64
#: Bytes that are hashed in one step.
STEP = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_SPACES = [0x20, *range(0x09, 0x0E)]

#: Words are what white space of ASCII separates.
SPACED = np.ones(256, dtype=bool)
SPACED[_SPACES] = False
#: Words are runs of 0-9, A-Z, a-z and everything beyond ASCII.
LETTERED = np.zeros(256, dtype=bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    LETTERED[_low : _high + 1] = True

_VALUES = np.random.default_rng(20).integers(1, 2**64, 256, dtype=U64)
_VALUES[0x41:0x5B] = _VALUES[0x61:0x7B]


class Words(NamedTuple):
    """``hashes`` of all words; those of text i are at ``bounds[i]:bounds[i + 1]``; bytes ``starts`` to ``ends``."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, base, dtype=U64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def words_of(texts: pa.Array, flags: np.ndarray) -> Words:
    """The words of every text; null and empty texts have none."""
    texts = binary(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = flags[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    first[cuts[cuts < len(data)]] |= inside[cuts[cuts < len(data)]]
    last[cuts[cuts > 0] - 1] |= inside[cuts[cuts > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), dtype=U64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + STEP, side="right")))
        low, high = starts[at], ends[to - 1]
        n = max(STEP, 1 << int(high - low - 1).bit_length())
        part = np.where(inside[low:high], _VALUES[data[low:high]], U64(0)) * _powers(n, _BASE)[: high - low]
        begin = starts[at:to] - low
        sums = np.add.reduceat(part, begin)
        hashes[at:to] = mixed(sums * _powers(n, pow(_BASE, -1, 2**64))[begin])
        at = to
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each ``n`` numbers in a row, order and ``n`` included; empty when there are fewer."""
    if len(hashes) < n:
        return np.empty(0, dtype=U64)
    out = np.full(len(hashes) - n + 1, n, dtype=U64)
    for i in range(n):
        out = out * U64(0xD6E8FEB86659FD93) + hashes[i : len(hashes) - n + 1 + i]
    return mixed(out)
