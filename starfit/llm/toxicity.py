"""Toxicity: a factorization machine over hashed terms.

Terms are the lower-cased words of a text and the first four, five and six bytes of the longer
ones, hashed into ``2**BUCKET_BITS`` buckets; a document's features are the distinct buckets it
holds, wherever in the text they stand. The model keeps the buckets whose presence differs most
between the two labels (chi-square over the training rows), and of the most frequent ones those
that tell the labels apart in pairs, though perhaps not alone. It learns a weight and a short
vector for each: the score of a pair of terms is the product of their vectors, so a word that is
harmless alone can count beside another.

Training reads a bounded sample: at most ``max_train`` labelled rows, those with the smallest
hash of their id. Counting and feature extraction of the sample run in tasks; the fit itself is
dense arithmetic over ``max_train`` x ``n_terms`` flags on the driver. Scoring is one pass over
all documents without a shuffle.

Defined cases: a null or empty text has no features and gets the model's base score; null
labels and labels other than 0 and 1 are not learned from; without rows of both labels every
score is as good as the label there is (0 without rows); repeated rows are scored each; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.arrays import BYTE_VALUES, Prefix, flat, mix, seeded, slices
from starfit.llm.tables import hash_share, remainder, scanned, staged
from starfit.llm.text_counts import IS_LETTER

BUCKET_BITS = 20
PREFIXES = (4, 5, 6)
HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 5, 0
LOWERED = BYTE_VALUES.copy()
LOWERED[0x41:0x5B] = BYTE_VALUES[0x61:0x7B]


@dataclass(frozen=True)
class Model:
    """place: feature number by bucket, -1 for none. Scores are sigmoid(bias + pairs)."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, rows: np.ndarray, terms: np.ndarray, n_rows: int) -> np.ndarray:
        """rows and terms: one entry per (row, present feature)."""
        linear = np.bincount(rows, weights=self.weights[terms], minlength=n_rows)
        pairs = np.zeros(n_rows)
        for f in range(self.vectors.shape[1]):
            v = self.vectors[terms, f]
            total = np.bincount(rows, weights=v, minlength=n_rows)
            pairs += total**2 - np.bincount(rows, weights=v**2, minlength=n_rows)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -500, 500)))


def term_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every term of a slice; pairs repeat as terms do."""
    letter = IS_LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, last = letter.copy(), letter.copy()
    start[1:] &= ~letter[:-1] | edge[1 : len(data)]
    last[:-1] &= ~letter[1:] | edge[1 : len(data)]
    starts, ends = np.flatnonzero(start), np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    prefix = Prefix(data, LOWERED)
    shift = np.uint64(64 - BUCKET_BITS)
    found = [(rows, seeded(prefix.of(starts, ends), 1) >> shift)]
    for size in PREFIXES:
        long = ends - starts > size
        found.append((rows[long], seeded(prefix.of(starts[long], starts[long] + size), 1 + size) >> shift))
    return np.concatenate([r for r, _ in found]), np.concatenate([b for _, b in found]).astype(np.int64)


def distinct_terms(
    data: np.ndarray, offsets: np.ndarray, place: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket), or with ``place`` distinct (row, feature) of the kept buckets."""
    rows, terms = term_buckets(data, offsets)
    if place is not None:
        terms = place[terms]
        rows, terms = rows[terms >= 0], terms[terms >= 0]
    both = np.unique(rows.astype(np.int64) << 32 | terms)
    return both >> 32, both & 0xFFFFFFFF


def _training_rows(docs: DataFrame, labels: DataFrame, id_column, text_column, label_column, max_train) -> DataFrame:
    """(text, label 0 or 1) of at most ``max_train`` labelled rows outside the held-out fold."""
    own = (
        labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull())
        .where(remainder("_id", HELD_OUT_MODULUS) != HELD_OUT_REMAINDER)
        .distinct()
    )
    # Drawn by a hash first, so that no task sends more than its share.
    drawn = hash_share(F.xxhash64("_id"), max_train + max_train // 4 + 100, own.count())
    own = own.where(drawn).orderBy(F.xxhash64("_id"), "_id", "_label").limit(max_train)
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    # At most max_train ids and labels, so the sample's size is bounded whatever the table's.
    return rows.join(F.broadcast(own), "_id").select("_text", "_label")


def _class_counts(rows: DataFrame) -> DataFrame:
    """(bucket, ones, zeros): how many rows of either label hold the bucket."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(batch.column(0))
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j in slices(offsets):
            with np.errstate(over="ignore"):
                row, bucket = distinct_terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            kinds, at = np.unique(bucket, return_inverse=True)
            ones = np.bincount(at, weights=label[i:j][row], minlength=len(kinds)).astype(np.int64)
            every = np.bincount(at, minlength=len(kinds))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(ones), pa.array(every - ones)], names=["bucket", "ones", "zeros"]
            )

    counted = scanned(rows, count, "bucket long, ones long, zeros long")
    return counted.groupBy("bucket").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))


def _features(rows: DataFrame, place: np.ndarray) -> DataFrame:
    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(batch.column(0))
        for i, j in slices(offsets):
            with np.errstate(over="ignore"):
                row, term = distinct_terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], place)
            bounds = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(i, j - i).cast(pa.int32()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(term.astype(np.int32))),
                ],
                names=["label", "terms"],
            )

    return scanned(rows, extract, "label int, terms array<int>")


def _matrix(rows: DataFrame, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """0 and 1 by row and feature, and the labels, of the bounded training rows."""
    sample = _features(rows, place).toArrow()  # max_train rows of at most ``width`` flags
    x = np.zeros((sample.num_rows, max(1, width)), np.uint8)
    terms = sample["terms"].combine_chunks()
    x[np.repeat(np.arange(len(terms)), np.diff(terms.offsets.to_numpy())), terms.flatten().to_numpy()] = 1
    return x, sample["label"].to_numpy().astype(np.float64)


def _skill(a, c, p: int, q: int):
    """Chi-square of a flag that ``a`` of p rows of label 1 and ``c`` of q others hold."""
    held = a + c
    return (p + q) * (a * q - c * p) ** 2 / np.maximum(held * (p + q - held) * p * q, 1)


def telling_pairs(x: np.ndarray, y: np.ndarray, least: float, most: int) -> list[int]:
    """Features of pairs that tell the labels apart by far better than either feature alone.

    Pairs come by how much better they do; at most ``most`` features are returned.
    """
    p, q = int(y.sum()), int((1 - y).sum())
    counts = [np.zeros((x.shape[1],) * 2, np.float32) for _ in range(2)]
    for part, label in zip(np.array_split(x, -(-len(x) // 2048)), np.array_split(y, -(-len(x) // 2048))):
        for k in (0, 1):
            flags = part[label == k].astype(np.float32)
            counts[k] += flags.T @ flags
    zeros, ones = (c.astype(np.float64) for c in counts)
    single = np.zeros(x.shape[1])
    single[:] = _skill(ones.diagonal(), zeros.diagonal(), p, q)
    gain = _skill(ones, zeros, p, q) - np.maximum(single[:, None], single)
    gain = np.triu(gain, 1)
    at = np.argsort(-gain, axis=None, kind="stable")[: 4 * most]
    found: dict[int, None] = {}
    for k in at[gain.ravel()[at] >= least].tolist():
        if len(found) + 2 > most:
            break
        found |= dict.fromkeys(divmod(k, x.shape[1]))
    return list(found)


def _fit(x: np.ndarray, y: np.ndarray, factors: int, steps: int, decay: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the log loss over mini-batches; x holds 0 and 1."""
    n, d = x.shape
    draw = np.random.default_rng(7)
    share = y.mean()
    size = 1 + d + d * factors
    theta = np.concatenate([[np.log(share / (1 - share))], np.zeros(d), draw.normal(0, 0.02, d * factors)])
    first, second = np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        rows = draw.integers(0, n, min(n, 1024))
        b, t = x[rows].astype(np.float32), y[rows]
        v = theta[1 + d :].reshape(d, factors)
        total = b @ v.astype(np.float32)
        pairs = ((total**2).sum(1) - b @ (v**2).sum(1).astype(np.float32)) / 2
        z = theta[0] + b @ theta[1 : 1 + d].astype(np.float32) + pairs
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - t).astype(np.float32) / len(rows)
        eb = b * error[:, None]
        g = np.concatenate(
            [[error.sum()], eb.sum(0), (eb.T @ total - v * eb.sum(0)[:, None]).ravel()]
        ).astype(np.float64)
        g[1:] += decay * theta[1:]
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        rate = 0.03 * min(1.0, 2 * (1 - step / (steps + 1)))
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return float(theta[0]), theta[1 : 1 + d], theta[1 + d :].reshape(d, factors)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    max_train: int = 20_000,
    n_terms: int = 1024,
    factors: int = 4,
    steps: int = 400,
    n_frequent: int = 1024,
    n_pair_terms: int = 256,
    pair_gain: float = 40.0,
) -> Model:
    """Fit the machine on rows outside the held-out fold. All bounds are fixed parameters.

    Terms are the ``n_terms`` that tell the labels apart best alone, and up to ``n_pair_terms`` of
    the ``n_frequent`` most frequent ones that do so in pairs: a pair must beat its better term's
    chi-square by ``pair_gain``.
    """
    # Written: documents are read once for training.
    rows = staged(_training_rows(docs, labels, id_column, text_column, label_column, max_train), "training-rows")
    sums = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("_label"), F.lit(0)).alias("ones")).first()
    place = np.full(1 << BUCKET_BITS, -1, np.int64)
    if sums.ones in (0, sums.n):
        return Model(place, 500.0 if sums.ones else -500.0, np.zeros(1), np.zeros((1, 1)))
    a, c = F.col("ones"), F.col("zeros")
    p, q = sums.ones, sums.n - sums.ones
    skill = (a * q - c * p) * (a * q - c * p).cast("double") / ((a + c) * (F.lit(sums.n) - a - c + 1))
    counts = staged(_class_counts(rows).where(a + c >= 3), "class-counts")
    best = counts.select("bucket", skill.cast("double").alias("skill")).orderBy(F.desc("skill"), "bucket")
    chosen = [r.bucket for r in best.limit(n_terms).collect()]
    often = counts.where(a + c < sums.n).orderBy(F.desc(a + c), "bucket").limit(n_frequent).collect()
    frequent = np.full(1 << BUCKET_BITS, -1, np.int64)
    frequent[[r.bucket for r in often]] = np.arange(len(often))
    paired = telling_pairs(*_matrix(rows, frequent, len(often)), pair_gain, n_pair_terms)
    chosen += [k for k in (often[i].bucket for i in paired) if k not in set(chosen)]
    place[chosen] = np.arange(len(chosen))
    x, y = _matrix(rows, place, len(chosen))
    order = np.lexsort((y, *x[:, :16].T))  # rows arrive in any order; draws must not depend on it
    return Model(place, *_fit(x[order], y[order], factors, steps, 1e-5))


def _scored(column: pa.Array, model: Model) -> Iterator[tuple[int, int, np.ndarray]]:
    data, offsets = flat(column)
    for i, j in slices(offsets):
        with np.errstate(over="ignore"):
            row, term = distinct_terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], model.place)
        yield i, j, model.scores(row, term, j - i)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    held = (remainder(id_column, HELD_OUT_MODULUS) == HELD_OUT_REMAINDER).alias("held_out")

    def apply(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, j, s in _scored(batch.column(2), model):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, j - i),
                    batch.column(1).slice(i, j - i),
                    pa.array(s),
                    pa.array((s >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(id_column).cast("long"), held, text_column)
    return scanned(rows, apply, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted to have label 0, with all their columns."""
    at = docs.columns.index(text_column)

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept = [s < 0.5 for _, _, s in _scored(batch.column(at), model)]
        if kept:
            yield batch.filter(pa.array(np.concatenate(kept)))

    return scanned(docs, keep, docs.schema)
