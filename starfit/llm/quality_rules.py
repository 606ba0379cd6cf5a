"""Quality rules: base counts, then compression bands.

A text whose bytes compress far better than prose of its length repeats itself; one that hardly
compresses is noise. Zstandard ratios (bytes by compressed bytes) of the whole document and of
its fixed chunks must lie in bands that depend on the length, since short inputs compress less
whatever they hold. The whole text is compressed and every chunk of it; a last one of less than
``MIN_CHUNK`` bytes is part of the chunk before, so that no byte goes unjudged.

Defined cases: null and empty texts have no words and fail the base rule; repeated rows are
judged one by one; null ids are returned; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.arrays import SEPARATORS, Words, flat, slices
from starfit.llm.tables import scanned
from starfit.llm.text_counts import IS_SYMBOL, OPENS, duplicate_lines, per_row, repeated_words

CHUNK = 4096
MIN_CHUNK = 512
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, ratio double, "
    "low_chunks long, high_chunks long, n_chunks long"
)


@dataclass(frozen=True)
class Bands:
    """Accepted ratios by length: (up to so many bytes, lowest, highest)."""

    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.7, 2.4),
        (1024, 1.1, 2.7),
        (4096, 1.35, 3.0),
        (16384, 1.5, 3.3),
        (float("inf"), 1.6, 3.6),
    )
    chunk: tuple[tuple[float, float, float], ...] = ((1024, 1.1, 2.8), (float("inf"), 1.3, 3.3))
    #: More than this share of a document's chunks outside their bands rejects it. Of 3 914 labelled
    #: documents of good quality with over 4 096 characters none had a chunk outside.
    chunk_share: float = 0.1
    level: int = 3


def _verdict(size: int, ratio: float, bands) -> int:
    """-1 below the band for this size, 1 above it, else 0."""
    for limit, low, high in bands:
        if size <= limit:
            return -1 if ratio < low else int(ratio > high)
    raise ValueError("the last band must be open")


def _bands(text: bytes, rules: Bands, packer) -> tuple[bool, float, int, int, int]:
    if not text:
        return False, 0.0, 0, 0, 0
    ratio = len(text) / len(packer.compress(text))
    low = high = n = 0
    starts = [at for at in range(0, len(text), CHUNK) if at == 0 or len(text) - at >= MIN_CHUNK]
    for at, to in zip(starts, [*starts[1:], len(text)]):
        chunk = text[at:to]
        if len(chunk) < MIN_CHUNK:  # a text shorter than any chunk is judged whole
            continue
        side = _verdict(len(chunk), len(chunk) / len(packer.compress(chunk)), rules.chunk)
        n, low, high = n + 1, low + (side < 0), high + (side > 0)
    inside = _verdict(len(text), ratio, rules.whole) == 0
    return inside and (low + high) <= rules.chunk_share * max(n, 1), ratio, low, high, n


@dataclass(frozen=True)
class Verdicts:
    """What is said of the texts of one slice, by row."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    base_failed: np.ndarray
    kept: np.ndarray
    bands: list[tuple[bool, float, int, int, int]]


def judge(data: np.ndarray, offsets: np.ndarray, rules: Bands) -> Verdicts:
    words = Words(data, offsets)
    repeats = repeated_words(words, len(offsets) - 1)
    _, dup_lines = duplicate_lines(data, offsets, words)
    failed = (words.counts < 20) | (100 * repeats > 30 * words.counts)
    packer = zstandard.ZstdCompressor(level=rules.level)
    raw = data.tobytes()
    bands = [_bands(raw[a:b], rules, packer) for a, b in zip(offsets[:-1], offsets[1:])]
    return Verdicts(
        words.counts,
        per_row(OPENS[data] & ~SEPARATORS[data], offsets),
        per_row(IS_SYMBOL[data], offsets),
        dup_lines,
        repeats,
        failed,
        ~failed & np.array([inside for inside, *_ in bands], bool),
        bands,
    )


def _judged(column: pa.Array, rules: Bands) -> Iterator[tuple[int, int, Verdicts]]:
    data, offsets = flat(column)
    for i, j in slices(offsets):
        with np.errstate(over="ignore"):
            yield i, j, judge(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], rules)


def compression_bands(
    docs: DataFrame, rules: Bands | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Counts, ratio and verdict of every document; columns as in ``SCHEMA``."""
    rules = rules or Bands()

    def report(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, j, said in _judged(batch.column(1), rules):
            _, ratio, low, high, chunks = zip(*said.bands)
            counts = (said.n_words, said.word_chars, said.n_symbols, said.n_dup_lines, said.n_repeat_words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, j - i),
                    *(pa.array(c.astype(np.int64)) for c in counts),
                    pa.array(said.base_failed),
                    pa.array(said.kept),
                    pa.array(ratio, pa.float64()),
                    *(pa.array(c, pa.int64()) for c in (low, high, chunks)),
                ],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return scanned(docs.select(F.col(id_column).cast("long"), text_column), report, SCHEMA)


def accepted(docs: DataFrame, rules: Bands | None = None, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns."""
    rules = rules or Bands()
    at = docs.columns.index(text_column)

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept = [said.kept for _, _, said in _judged(batch.column(at), rules)]
        if kept:
            yield batch.filter(pa.array(np.concatenate(kept)))

    return scanned(docs, keep, docs.schema)
