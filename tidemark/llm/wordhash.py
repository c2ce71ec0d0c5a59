"""Words of many texts at once, as 64-bit hashes, on UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in pieces of about this many bytes, cut between words.
BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers = {}

# In UTF-8 every byte of a character beyond ASCII is 0x80 or more, so classes of ASCII characters
# are classes of bytes.
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_lo:_hi + 1] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, BLOCK * 2), base, np.uint64)
        steps[0] = 1
        held = _powers[base] = np.cumprod(steps)
    return held[:n]


def texts(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, starts): documents first..last-1 of a column, a line feed after each.

    Null is empty. A group holds about ``limit`` bytes, or one document that is longer.
    """
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][:len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(column))
        starts = offsets[first:last + 1] - offsets[first] + np.arange(last - first + 1)
        joined = np.full(int(starts[-1]), 10, np.uint8)
        for i in range(last - first):
            lo, hi = offsets[first + i], offsets[first + i + 1]
            joined[starts[i]:starts[i] + hi - lo] = data[lo:hi]
        yield first, last, joined, starts
        first = last


def words(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words in ``data``; A-Z count as a-z."""
    inverse = pow(_BASE, -1, 1 << 64)
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data) and is_word[data[end]]:  # not inside a word
            gap = np.flatnonzero(~is_word[data[end:end + BLOCK]])
            end = min(len(data), end + (int(gap[0]) if len(gap) else BLOCK))
        block = data[at:end]
        inside = np.zeros(len(block) + 2, np.int8)
        inside[1:-1] = is_word[block]
        edges = np.flatnonzero(np.diff(inside))
        lo, hi = edges[::2], edges[1::2]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((_LOWER[block] + np.uint64(1)) * powers(_BASE, len(block)), out=sums[1:])
        h = (sums[hi] - sums[lo]) * powers(inverse, len(block))[lo]
        found.append((lo + at, hi + at, mix(h ^ (hi - lo).astype(np.uint64))))
        at = end
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))
