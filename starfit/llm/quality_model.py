"""Quality classifier: ridge regression on random Fourier features, calibrated isotonically.

Every document becomes a short vector of statistics of its whole text (``STATISTICS``). Cosines
of random projections of the standardised vector approximate a Gaussian kernel, so that a linear
fit on them is a kernel fit. The fit needs only sums over rows: each task adds up its part of
the normal equations, a shuffle by matrix row adds the tasks' parts, and one small system is
solved. The sums are kept by fold, so that the ridge scores used for calibration come from a fit
that has not seen the row. Calibration pools adjacent violators over a fixed histogram of those
scores. Nothing is sampled: all labelled rows outside the held-out fold take part.

Defined cases: null and empty texts have zero statistics and are scored as such; null labels and
labels other than 0 and 1 are not learned from; without rows of both labels every score is the
share of label 1 (0 without rows); repeated rows are scored each; other columns are not read.
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
from starfit.llm.tables import remainder, scanned, staged
from starfit.llm.text_counts import (
    IS_DIGIT,
    IS_LETTER,
    IS_MARK,
    IS_SHOUT,
    IS_SYMBOL,
    IS_UPPER,
    duplicate_lines,
    grouped,
    per_row,
    repeated_words,
)

HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 3, 1
STATISTICS = [
    "log_words", "mean_word", "upper", "digits", "symbols", "shouts", "marks", "repeated",
    "distinct", "commonest", "duplicate_lines", "words_a_line", "lone_marks", "log_ratio", "high_bytes",
]
BINS = 1000


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` per text of a slice."""
    n = len(offsets) - 1
    words = Words(data, offsets)
    count = np.maximum(words.counts, 1)
    size = np.maximum(per_row(~SEPARATORS[data], offsets), 1)
    letters = np.maximum(per_row(IS_LETTER[data], offsets), 1)
    share = lambda table, of: per_row(table[data], offsets) / of
    order, at, sizes = grouped(words.rows, words.hashes)
    distinct = np.bincount(words.rows[order[at]], minlength=n) if len(order) else np.zeros(n)
    commonest = np.zeros(n)
    if len(order):
        np.maximum.at(commonest, words.rows[order[at]], sizes)
    lines, dup = duplicate_lines(data, offsets, words)
    lone = (words.ends - words.starts == 1) & ~IS_LETTER[data[words.starts]] if len(words.starts) else np.zeros(0, bool)
    packer = zstandard.ZstdCompressor(level=1)
    raw = data.tobytes()
    ratio = [(b - a) / len(packer.compress(raw[a:b])) if b > a else 1.0 for a, b in zip(offsets[:-1], offsets[1:])]
    return np.column_stack(
        [
            np.log1p(words.counts),
            size / count,
            share(IS_UPPER, letters),
            share(IS_DIGIT, size),
            share(IS_SYMBOL, size),
            share(IS_SHOUT, size),
            share(IS_MARK, size),
            repeated_words(words, n) / count,
            distinct / count,
            commonest / count,
            dup / np.maximum(lines, 1),
            np.log1p(count / np.maximum(lines, 1)),
            np.bincount(words.rows[lone], minlength=n) / count,
            np.log(ratio),
            per_row(data >= 0x80, offsets) / size,
        ]
    )


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and its vector ``x``."""

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(batch.column(1))
        for i, j in slices(offsets):
            with np.errstate(over="ignore"):
                x = statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(j - i + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i).cast(pa.int64()), lists], names=["doc_id", "x"]
            )

    return scanned(docs.select(id_column, text_column), measure, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass(frozen=True)
class Features:
    """Random cosines of the standardised, clipped statistics, and a constant."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @staticmethod
    def draw(mean: np.ndarray, scale: np.ndarray, n_features: int, width: float, seed: int) -> Features:
        rng = np.random.default_rng(seed)
        return Features(
            mean, scale, rng.normal(0, 1 / width, (len(mean), n_features)), rng.uniform(0, 2 * np.pi, n_features)
        )

    def of(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / self.directions.shape[1])
        return np.column_stack([waves, np.ones(len(x))])


@dataclass(frozen=True)
class Model:
    features: Features | None
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), self.levels[0])
        return np.interp(self.features.of(x) @ self.weights, self.knots, self.levels)


def _normal_equations(rows: DataFrame, features: Features) -> dict[int, np.ndarray]:
    """By fold, the sum of z zᵀ with z = (features, label), each task adding up its own rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            fold = batch.column(2).to_numpy(zero_copy_only=False)
            for f in np.unique(fold):
                z = np.column_stack([features.of(x[fold == f]), y[fold == f]])
                sums[int(f)] = sums.get(int(f), 0) + z.T @ z
        for f, matrix in sums.items():
            n = len(matrix)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, f)),
                    pa.array(np.arange(n)),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * n), pa.array(matrix.ravel())),
                ],
                names=["fold", "line", "part"],
            )

    def total(key, table):
        parts = _matrix(table["part"])
        order = np.lexsort(parts.T[:3])  # tasks arrive in any order; floating sums must not depend on it
        summed = parts[order].sum(0)
        return pa.table({"fold": [key[0].as_py()], "line": [key[1].as_py()], "part": [summed]})

    schema = "fold long, line long, part array<double>"
    lines = rows.mapInArrow(add, schema).groupBy("fold", "line").applyInArrow(total, schema).toArrow()
    out = {}
    fold, line, part = lines["fold"].to_numpy(), lines["line"].to_numpy(), _matrix(lines["part"])
    for f in np.unique(fold):
        out[int(f)] = part[fold == f][np.argsort(line[fold == f])]
    return out


def _solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    a, b = sums[:-1, :-1], sums[:-1, -1]
    penalty = np.full(len(b), ridge)
    penalty[-1] = 1e-9  # the constant is not shrunk
    return np.linalg.solve(a + np.diag(penalty), b)


def pool_adjacent_violators(means: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence closest to ``means`` by weighted squares."""
    blocks: list[list[float]] = []
    for m, w in zip(means, weights):
        blocks.append([m, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, n2 = blocks.pop()
            m1, w1, n1 = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), m) for m, _, n in blocks])


def _calibrate(rows: DataFrame, features: Features, by_fold: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels from a histogram of out-of-fold scores over [-0.5, 1.5]."""

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        z, fold = features.of(_matrix(batch.column(0))), batch.column(2).to_numpy(zero_copy_only=False)
        s = np.zeros(len(z))
        for f, w in by_fold.items():
            s[fold == f] = z[fold == f] @ w
        bins = np.clip(((s + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)
        yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1).cast(pa.int64())], names=["bin", "y"])

    counted = (
        scanned(rows, score, "bin long, y long").groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n"))
    ).toArrow()  # at most BINS rows
    bins, y, n = (counted[c].to_numpy().astype(float) for c in ("bin", "y", "n"))
    order = np.argsort(bins)
    bins, y, n = bins[order], y[order], n[order]
    levels = pool_adjacent_violators(y / n, n)
    # One knot per block, at its mean place, and straight lines between: scores keep their order.
    at = np.flatnonzero(np.concatenate([[True], levels[1:] > levels[:-1]]))
    middle = np.add.reduceat(bins * n, at) / np.add.reduceat(n, at)
    return (middle + 0.5) / BINS * 2 - 0.5, levels[at]


def train(
    vectors: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    label_column: str = "quality",
    n_features: int = 256,
    width: float = 3.0,
    ridge: float = 0.01,
    seed: int = 11,
) -> Model:
    """Fit on all labelled rows outside the held-out fold; ``vectors`` as ``document_statistics``."""
    own = (
        labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(remainder("doc_id", HELD_OUT_MODULUS) != HELD_OUT_REMAINDER)
        .distinct()
    )
    fold = F.when(remainder("doc_id", HELD_OUT_MODULUS) < HELD_OUT_REMAINDER, 0).otherwise(1).cast("long")
    rows = staged(vectors.join(own, "doc_id").select("x", "y", fold.alias("fold")), "quality-rows")
    moments = []
    for k in range(len(STATISTICS)):
        value = F.get("x", F.lit(k))
        moments += [F.avg(value).alias(f"m{k}"), F.stddev_pop(value).alias(f"s{k}")]
    sums = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("ones"), *moments).first()
    if sums.ones in (0, sums.n):
        return Model(None, np.zeros(0), np.zeros(1), np.array([sums.ones / max(sums.n, 1)]))
    mean = np.array([sums[f"m{k}"] for k in range(len(STATISTICS))])
    scale = np.array([max(sums[f"s{k}"], 1e-6) for k in range(len(STATISTICS))])
    features = Features.draw(mean, scale, n_features, width, seed)
    by_fold = _normal_equations(rows, features)
    whole = sum(by_fold.values())
    others = {f: _solve(whole - s if len(by_fold) > 1 else s, ridge) for f, s in by_fold.items()}
    return Model(features, _solve(whole, ridge), *_calibrate(rows, features, others))


def score(vectors: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every vector."""
    held = (remainder("doc_id", HELD_OUT_MODULUS) == HELD_OUT_REMAINDER).alias("held_out")

    def apply(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        s = model.scores(_matrix(batch.column(2)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )

    return scanned(
        vectors.select("doc_id", held, "x"), apply, "doc_id long, held_out boolean, score double, predicted int"
    )
