"""K2-treap: a sparse grid of weights as a quadtree of maxima.

The grid is padded to a square with a power of two as its side and cut into four again and again.
A cell without a point is not stored. Every level holds, cell by cell of the level above, four
bits that say which quarters hold points, and for each of those the difference between the
maximum of the cell above and its own. A quarter's place in its level is the number of set bits
before it, so no pointers are kept; the differences are small and are compressed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_CODEC = "zstd"


def spread(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits of each number, moved to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def pack(values: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, compressed; their count comes first."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec=_CODEC, asbytes=True)


def unpack(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = pa.decompress(raw[8:], decompressed_size=4 * n, codec=_CODEC, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").ravel()


@dataclass
class Level:
    """One level's quarters: which exist, and how far their maxima lie under the cell's above."""

    words: np.ndarray
    before: np.ndarray
    under: np.ndarray

    @staticmethod
    def of(bits: bytes, under: np.ndarray) -> Level:
        words = np.frombuffer(bits + b"\0" * (-len(bits) % 8), np.uint64)
        counts = np.bitwise_count(words).astype(np.int64)
        return Level(words, np.cumsum(counts) - counts, under.astype(np.int64))

    def quarter(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the quarters at these places exist, and the place of each that does."""
        word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
        there = (word >> bit) & np.uint64(1) > 0
        word, bit, at = word[there], bit[there], at[there]
        below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        return there, self.before[at >> 6] + below.astype(np.int64)


@dataclass
class K2Treap:
    """Levels from the root's quarters down to the points."""

    height: int
    largest: int
    levels: list[Level]

    @staticmethod
    def build(rows: np.ndarray, columns: np.ndarray, weights: np.ndarray) -> tuple[int, int, list[bytes], list[bytes]]:
        """Height, largest weight, and the levels' bits and differences, of distinct points."""
        side = int(max(rows.max(initial=0), columns.max(initial=0))) + 1
        height = max(1, (side - 1).bit_length())
        code = spread(rows) << np.uint64(1) | spread(columns)
        order = np.argsort(code)
        code, most = code[order], weights[order].astype(np.int64)
        bits, under = [], []
        for _ in range(height):
            above = code >> np.uint64(2)
            heads = np.flatnonzero(np.append(len(above) > 0, above[1:] != above[:-1])[: len(above)])
            parent = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(above))))
            maxima = np.maximum.reduceat(most, heads) if len(heads) else most
            flags = np.zeros(4 * len(heads), np.uint8)
            flags[4 * parent + (code & np.uint64(3)).astype(np.int64)] = 1
            bits.append(np.packbits(flags, bitorder="little").tobytes())
            under.append(pack(maxima[parent] - most))
            code, most = above[heads], maxima
        return height, int(most.max(initial=0)), bits[::-1], under[::-1]

    @staticmethod
    def load(height: int, largest: int, bits: list[bytes], under: list[bytes]) -> K2Treap:
        return K2Treap(height, largest, [Level.of(b, unpack(u)) for b, u in zip(bits, under)])

    def step(
        self, depth: int, rows: np.ndarray, cells: np.ndarray, most: np.ndarray, right: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From cells of a depth to the quarter on the rows' paths, in the left or right half.

        Returns which quarters exist, their places and their maxima.
        """
        down = (rows >> (self.height - 1 - depth)) & 1
        level = self.levels[depth]
        there, cells = level.quarter(4 * cells + 2 * down + right)
        return there, cells, most[there] - level.under[cells]
