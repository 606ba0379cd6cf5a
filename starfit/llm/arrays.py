"""NumPy helpers over the bytes of many texts at once, for use inside Arrow batches.

A column of texts is one byte array plus offsets, so scanning it costs a few array passes
rather than a Python loop over words. Hashes are 64-bit polynomials of the bytes with an odd
base, finished by a mixing step. Powers of the base come from a table, so positions are
relative to the slice at hand; callers cut their batches with ``slices``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 1 << 19
#: Bytes that part words: space and 0x09 to 0x0D.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + np.uint64((seed * BASE + 0x632BE59BD9B4E019) % (1 << 64)))


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    out = np.empty(size, np.uint64)
    out[0] = 1
    have = 1
    while have < size:
        more = min(have, size - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


def powers(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64; tables for usual sizes are kept."""
    room = 1 << max(10, (size - 1).bit_length())
    if (base, room) not in _POWERS:
        table = _powers(base, room)
        if room > 2 * SLICE_BYTES:
            return table[:size]
        _POWERS[base, room] = table
    return _POWERS[base, room][:size]


INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, bounds, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(bounds, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    if column.null_count:
        keep = column.is_valid().to_numpy(zero_copy_only=False)
        if np.any(np.diff(offsets)[~keep]):
            return flat(column.fill_null(""))
    bytes_ = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return bytes_, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of up to ``limit`` bytes, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


class Prefix:
    """Hash of any stretch of a byte array from prefix sums."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES):
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(values[data] * powers(BASE, len(data)), out=self.sums[1:])
        self.back = powers(INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def every(self, size: int) -> np.ndarray:
        """Hashes of all stretches of ``size`` bytes, by start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[size:] - self.sums[:n]) * self.back[:n]


class Words:
    """Words of the rows of one slice: byte spans, row numbers and hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        sep = SEPARATORS[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        edge = first[: len(data)]
        start = ~sep
        start[1:] &= sep[:-1] | edge[1:]
        last = ~sep
        last[:-1] &= sep[1:] | first[1 : len(data)]
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(last) + 1
        self.rows = np.searchsorted(offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.rows, minlength=len(offsets) - 1)
        values = BYTE_VALUES
        if lower:
            values = BYTE_VALUES.copy()
            values[0x41:0x5B] = BYTE_VALUES[0x61:0x7B]
        self.hashes = seeded(Prefix(data, values).of(self.starts, self.ends), 1) + (
            (self.ends - self.starts).astype(np.uint64)
        )

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words within a row, and each one's first word."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for i in range(size):
            total += mix(self.hashes[i : i + n] + np.uint64(i + 1)) * np.uint64(pow(BASE, 2 * i + 1, 1 << 64))
        inside = np.flatnonzero(self.rows[:n] == self.rows[size - 1 :])
        return mix(total[inside]), inside
