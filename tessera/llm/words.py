"""Word arrays for whole Arrow batches of text.

A *word* is a maximal run of ASCII digits, ASCII letters and non-ASCII
characters after A-Z is lower-cased, that is a match of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  Every byte of a non-ASCII character is
0x80 or more, so words can be found on the UTF-8 bytes.  Null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
#: Bytes of text that are worked on at once: the arrays below take about forty times as much.
SLICE_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): neighbouring inputs give unrelated outputs."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_cached: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1) modulo 2**64; a worker keeps no more of them than a usual slice needs."""
    have = _cached.get(base)
    if have is None or len(have) < n:
        have = _powers(base, min(2 * n, SLICE_BYTES + 64) if n <= SLICE_BYTES + 64 else n)
        if n <= SLICE_BYTES + 64:
            _cached[base] = have
    return have[:n]


@dataclass
class Words:
    """Words of several texts: word i is bytes[starts[i]:ends[i]]; text t has words offsets[t]:offsets[t+1]."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def hashes(self) -> np.ndarray:
        """One 64-bit hash for each word, the same wherever the word stands."""
        n = len(self.raw)
        if not n or not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[self.raw] * powers(_BASE, n), out=total[1:])
        h = (total[self.ends] - total[self.starts]) * powers(_INVERSE, n)[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64))

    def text_of(self) -> np.ndarray:
        """The index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]].tobytes()


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows that hold about ``most`` bytes at most; a longer text stands alone."""
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield at, min(upto, len(column))
        at = upto


def split(column: pa.Array) -> Words:
    """The words of each text of an Arrow string array."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return Words(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = _LOWER[whole[at[0] : at[-1]]]
    at = at - at[0]
    inside = _IS_WORD[raw]
    before = np.zeros(len(raw) + 1, dtype=bool)
    before[1:] = inside
    before[at] = False
    after = np.zeros(len(raw) + 1, dtype=bool)
    after[:-1] = inside
    after[at] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(raw, starts, ends, np.searchsorted(starts, at))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of ``width`` consecutive words from each position on (none for the last width-1)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        total *= np.uint64(_BASE)
        total += hashes[j : j + n]
    return mix(total)


def within(offsets: np.ndarray, width: int) -> np.ndarray:
    """For windows of ``width`` words over all texts: True where the window stays inside one text."""
    n = int(offsets[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    last = np.repeat(offsets[1:], np.diff(offsets))[:n]
    return np.arange(n) + width <= last
