"""Words and hashes of Arrow text columns, computed on the bytes of many texts at once.

All hashes are polynomial over 64-bit values of the bytes (arithmetic wraps), so the hash of any
byte range comes from two prefix sums.  The values depend on nothing but the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20  # bytes of text handled together; a longer text is a slice of its own


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n, modulo 2 ** 64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = 1 << max(n, SLICE).bit_length()
        have = np.full(size, base & (2**64 - 1), np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE:
            _powers[base] = have
    return have[:n + 1]


def inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``SLICE`` bytes: first row, end row, bytes, offsets."""
    raw, offsets = utf8(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, raw[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[raw] * powers(BASE, len(raw))[:-1], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, from the prefix sums of their slice."""
    back = powers(inverse(BASE), len(sums) - 1)
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slice: start, end, document (row in the slice), hash."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, fold: bool = False):
        self.raw = FOLD[raw] if fold else raw
        n = len(raw)
        inside = ~SPACE[raw]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
        start = inside & (~before | edge[:-1])
        after = np.empty(n, bool)
        if n:
            after[-1] = False
            after[:-1] = inside[1:]
        last = inside & (~after | edge[1:])
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(last) + 1
        self.document = np.searchsorted(offsets, self.start, "right") - 1
        #: words before the first of each document
        self.first = np.searchsorted(self.start, offsets)
        self.hash = range_hash(prefix_sums(self.raw), self.start, self.end)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` consecutive word hashes (over document edges as well)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i:i + n]
    return mix(out)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of each run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
