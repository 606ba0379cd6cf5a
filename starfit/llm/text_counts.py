"""Counts over the words, lines and symbols of many texts at once."""

from __future__ import annotations

import numpy as np

from starfit.llm.arrays import Prefix, Words, mix

SYMBOLS = b"#*$%&|<>"


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


IS_SYMBOL = byte_set(SYMBOLS)
IS_UPPER = byte_set(bytes(range(0x41, 0x5B)))
IS_LETTER = byte_set(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
IS_DIGIT = byte_set(b"0123456789")
IS_MARK = byte_set(b".,;:!?'\"()-")
IS_SHOUT = byte_set(b"!?")
#: First bytes of code points: all but 0x80 to 0xBF.
OPENS = np.ones(256, bool)
OPENS[0x80:0xC0] = False


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row's bytes."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def grouped(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by (row, key): the order, where groups start in it, and their sizes."""
    order = np.lexsort((keys, rows))
    r, k = rows[order], keys[order]
    head = np.ones(len(order), bool)
    head[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(head)
    return order, at, np.diff(np.append(at, len(order)))


def repeated_words(words: Words, n_rows: int, size: int = 8) -> np.ndarray:
    """Per row, the words that lie in a window of ``size`` words found twice or more there."""
    hashes, first = words.windows(size)
    if len(first) == 0:
        return np.zeros(n_rows, np.int64)
    order, _, sizes = grouped(words.rows[first], hashes)
    again = first[order[np.repeat(sizes > 1, sizes)]]
    cover = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + size, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return np.bincount(words.rows[covered], minlength=n_rows)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per row, its lines with a word, and those of them equal to an earlier one.

    A line is known by a hash of its bytes and its length.
    """
    n_rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    if len(starts) == 0:
        return np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
    ends = np.append(starts[1:], len(data))
    ends = np.where((ends > starts) & (data[ends - 1] == 0x0A), ends - 1, ends)
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[worded], ends[worded]
    rows = np.searchsorted(offsets, starts, "right") - 1
    hashes = mix(Prefix(data).of(starts, ends) + (ends - starts).astype(np.uint64))
    order, at, sizes = grouped(rows, hashes)
    lines = np.bincount(rows, minlength=n_rows)
    distinct = np.bincount(rows[order[at]], minlength=n_rows)
    return lines, lines - distinct
