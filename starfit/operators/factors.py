"""Latent factors of users and movies by alternating least squares, on what a model leaves over.

Minimized is the squared error of ``residual - p_u . q_i`` plus ``lam`` times all squared factors.
With one side's factors fixed, each key of the other has normal equations of its own.

Ratings are packed once for each side into blocks: a block holds the ratings of some keys, sorted by
key, with each rating's other key as a place in the block's list of other keys. A route table says
which blocks need a key's factors. So an iteration ships each factor vector once to every block
that needs it, not once a rating, and a block's equations are built from matrices in a task.
Blocks hold a bounded number of ratings. The ratings of a key with more than that are dealt to several
blocks; their equations are added up before they are solved.

Ratings without a user or a movie are left out, and so are keys without factors from predictions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfit.functions import or_zero
from starfit.operators.effects import PREDICTION, RATING, EffectsModel
from starfit.operators.keyed import SMALL_BYTES, KeyedTable, attach
from starfit.sources.staging import stage

USER, MOVIE = "userId", "movieId"
#: Ratings of a block.
BLOCK_ROWS = 200_000
#: Ratings whose outer products are held at once.
_AT_ONCE = 20_000


def first_factors(key: Column, rank: int) -> Column:
    """Numbers from -1/2 to 1/2 that depend on the key alone, the same on every run."""
    digits = [F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(c)))), 1, 6) for c in range(rank)]
    return F.array(*[F.conv(d, 16, 10).cast("double") / F.lit(float(1 << 24)) - 0.5 for d in digits])


def normal_equations(factors: np.ndarray, places: np.ndarray, ratings: np.ndarray, bounds: np.ndarray):
    """Gram matrices and right sides of keys whose ratings lie between ``bounds``."""
    n, rank = len(bounds) - 1, factors.shape[1]
    grams, sides = np.zeros((n, rank, rank)), np.zeros((n, rank))
    for at in range(0, len(places), _AT_ONCE):
        to = min(at + _AT_ONCE, len(places))
        a = int(np.searchsorted(bounds, at, "right")) - 1
        b = int(np.searchsorted(bounds, to, "left"))
        x = factors[places[at:to]]
        starts = np.maximum(bounds[a:b], at) - at  # no key is without ratings
        grams[a:b] += np.add.reduceat(x[:, :, None] * x[:, None, :], starts, axis=0)
        sides[a:b] += np.add.reduceat(x * ratings[at:to, None], starts, axis=0)
    return grams, sides


def solved(grams: np.ndarray, sides: np.ndarray, lam: float) -> np.ndarray:
    return np.linalg.solve(grams + lam * np.eye(sides.shape[1]), sides[:, :, None])[:, :, 0]


@dataclass(frozen=True)
class Side:
    """One side's blocks and the routes of the other side's factors to them."""

    key: str
    blocks: DataFrame
    routes: DataFrame
    split: bool

    @staticmethod
    def pack(ratings: DataFrame, key: str, other: str, block_rows: int) -> Side:
        """``ratings``: both keys and ``_r``. Written."""
        counts = stage(ratings.groupBy(key).agg(F.count("*").alias("_n")), "key-counts")
        told = counts.agg(F.sum("_n").alias("n"), F.max("_n").alias("most")).first()
        n_blocks = -(-int(told.n or 0) // block_rows) or 1
        split = (told.most or 0) > block_rows
        dealt = ratings.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(n_blocks)))
        dealt = dealt.withColumn("_parted", F.lit(False))
        if split:
            # Fewer keys than blocks have more ratings than a block holds.
            large = counts.where(F.col("_n") > block_rows).select(F.col(key).alias("_large"), "_n")
            parts = F.ceil(F.col("_n") / F.lit(block_rows))
            marked = ratings.join(F.broadcast(large), F.col(key) == F.col("_large"), "left")
            part = F.pmod(F.xxhash64(other, "_r"), F.coalesce(parts, F.lit(1)))
            dealt = marked.withColumn("_block", F.pmod(F.xxhash64(key, part), F.lit(n_blocks)))
            dealt = dealt.withColumn("_parted", F.col("_large").isNotNull())
        dealt = dealt.select("_block", F.col(key).alias("_key"), F.col(other).alias("_other"), "_r", "_parted")

        def packed(table: pa.Table) -> pa.Table:
            own, places = np.unique(table["_key"].to_numpy(), return_inverse=True)
            others, far = np.unique(table["_other"].to_numpy(), return_inverse=True)
            order = np.lexsort((far, places))
            bounds = np.searchsorted(places[order], np.arange(len(own) + 1))
            parted = np.zeros(len(own), bool)
            parted[places] = table["_parted"].to_numpy(zero_copy_only=False)
            columns = own, parted, bounds, others, far[order], table["_r"].to_numpy()[order]
            kinds = np.int64, bool, np.int64, np.int64, np.int32, np.float64
            raw = [pa.array([c.astype(k).tobytes()], pa.binary()) for c, k in zip(columns, kinds)]
            return pa.table([table["_block"].slice(0, 1), *raw], names=["_block", *_PACKED])

        schema = "_block long, " + ", ".join(f"{c} binary" for c in _PACKED)
        blocks = stage(dealt.groupBy("_block").applyInArrow(packed, schema), f"{key}-blocks")
        # A block names each of its other keys once: no need to deal the ratings again.
        routes = blocks.select("_block", "others").mapInArrow(_routed, "_other long, _block long")
        routes = stage(routes, f"{key}-routes")
        return Side(key, blocks, routes, split)

    def update(self, factors: DataFrame, lam: float, rank: int) -> DataFrame:
        """(key, factors) of this side from the other's, written."""
        sent = self.routes.join(factors.select(F.col("key").alias("_other"), "factors"), "_other")

        def solve(blocks: pa.Table, sent: pa.Table) -> pa.Table:
            if blocks.num_rows == 0 or sent.num_rows == 0:
                return _equations([], np.zeros((0, rank)), None, None)
            own, parted, bounds, others, far, ratings = (
                np.frombuffer(blocks[c][0].as_py(), k) for c, k in zip(_PACKED, _KINDS)
            )
            got = sent["_other"].to_numpy()
            order = np.argsort(got)
            values = sent["factors"].combine_chunks().flatten().to_numpy().reshape(-1, rank)[order]
            # Every key that the block needs was sent: both sides have a factor for every rating.
            values = values[np.searchsorted(got[order], others)]
            grams, sides = normal_equations(values, far, ratings, bounds)
            whole = ~parted
            found = np.zeros((len(own), rank))
            found[whole] = solved(grams[whole], sides[whole], lam)
            return _equations(own, found, parted, np.concatenate([grams.reshape(len(own), -1), sides], axis=1))

        def add(table: pa.Table) -> pa.Table:
            width = rank * (rank + 1)
            total = table["equations"].combine_chunks().flatten().to_numpy().reshape(-1, width).sum(axis=0)
            grams, sides = total[: rank * rank].reshape(1, rank, rank), total[rank * rank :].reshape(1, rank)
            return _factors(table["key"].to_numpy()[:1], solved(grams, sides, lam))

        both = self.blocks.groupBy("_block").cogroup(sent.groupBy("_block"))
        schema = "key long, factors array<double>, equations array<double>"
        made = both.applyInArrow(solve, schema)
        if not self.split:
            return stage(made.select("key", "factors"), f"{self.key}-factors")
        made = stage(made, f"{self.key}-equations")
        # A key's equations from each of its blocks, of which there are n / BLOCK_ROWS at most.
        summed = made.where("equations IS NOT NULL").groupBy("key").applyInArrow(add, "key long, factors array<double>")
        return stage(made.where("equations IS NULL").select("key", "factors").unionByName(summed), f"{self.key}-factors")


def _routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, others in zip(batch["_block"], batch["others"]):
            keys = np.frombuffer(others.as_buffer(), np.int64)
            yield pa.RecordBatch.from_pydict({"_other": keys, "_block": np.full(len(keys), block.as_py())})


_PACKED = ("own", "parted", "bounds", "others", "far", "ratings")
_KINDS = (np.int64, bool, np.int64, np.int64, np.int32, np.float64)


def _lists(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, width, dtype=np.int32)), pa.array(rows.ravel()))


def _factors(keys: np.ndarray, rows: np.ndarray) -> pa.Table:
    return pa.table({"key": pa.array(keys, pa.int64()), "factors": _lists(rows)})


def _equations(keys, found: np.ndarray, parted: np.ndarray | None, sums: np.ndarray | None) -> pa.Table:
    """Factors of whole keys; of parted ones, what is still to be added up."""
    factors = _lists(found)
    if parted is None or not parted.any():
        equations = pa.nulls(len(keys), pa.list_(pa.float64()))
    else:
        at = np.cumsum(parted) - 1
        kept = _lists(sums[parted])
        equations = kept.take(pa.array(at, mask=~parted))
        factors = pa.array(factors.to_pylist(), pa.list_(pa.float64()))
    return pa.table({"key": pa.array(keys, pa.int64()), "factors": factors, "equations": equations})


@dataclass(frozen=True)
class FactorModel:
    """Factors on top of a model; tables hold userId or movieId and ``_p`` or ``_q``."""

    base: EffectsModel
    rank: int
    users: KeyedTable
    movies: KeyedTable

    def predict(self, rows: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
        """The model's prediction plus ``b_f``, the product of the factors, 0 for unseen keys."""
        joined = attach(self.base.predict(rows, small_bytes), [self.users, self.movies], small_bytes)
        product = F.aggregate(F.zip_with("_p", "_q", lambda p, q: p * q), F.lit(0.0), lambda a, x: a + x)
        return (
            joined.withColumn("b_f", or_zero(product))
            .withColumn(PREDICTION, F.col(PREDICTION) + F.col("b_f"))
            .drop("_p", "_q")
        )


def _keyed(factors: DataFrame, key: str, name: str) -> KeyedTable:
    return KeyedTable.measure(factors.select(F.col("key").alias(key), F.col("factors").alias(name)), [key])


def residuals(train: DataFrame, base: EffectsModel) -> DataFrame:
    """userId, movieId and what the model leaves of the rating, for rows with both keys. Written."""
    columns = dict.fromkeys([USER, MOVIE, *base.reads, RATING])
    rows = base.predict(train.select(*columns).where(f"{USER} IS NOT NULL AND {MOVIE} IS NOT NULL"))
    left = (F.col(RATING) - F.col(PREDICTION)).alias("_r")
    return stage(rows.select(F.col(USER).cast("long"), F.col(MOVIE).cast("long"), left), "residuals")


def fit_factors(
    train: DataFrame, base: EffectsModel, rank: int, lam: float, iterations: int, block_rows: int = BLOCK_ROWS
) -> FactorModel:
    """Start from ``first_factors`` of the movies; an iteration fits the users, then the movies."""
    if lam <= 0:
        raise ValueError("the penalty must be positive: keys with few ratings have no other solution")
    left = residuals(train, base)
    by_user = Side.pack(left, USER, MOVIE, block_rows)
    by_movie = Side.pack(left, MOVIE, USER, block_rows)
    movies = left.select(MOVIE).distinct()
    movies = stage(movies.select(F.col(MOVIE).alias("key"), first_factors(F.col(MOVIE), rank).alias("factors")), "first")
    users = by_user.update(movies, lam, rank)
    for k in range(iterations):
        users = by_user.update(movies, lam, rank) if k else users
        movies = by_movie.update(users, lam, rank)
    return FactorModel(base, rank, _keyed(users, USER, "_p"), _keyed(movies, MOVIE, "_q"))


def penalized_loss(train: DataFrame, model: FactorModel, lam: float) -> float:
    """What the fit minimizes."""
    rows = model.predict(train.where(f"{USER} IS NOT NULL AND {MOVIE} IS NOT NULL"))
    error = rows.agg(F.sum((F.col(RATING) - F.col(PREDICTION)) ** 2)).first()[0] or 0.0
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)
    sizes = [t.frame.agg(F.sum(square(c))).first()[0] or 0.0 for t, c in ((model.users, "_p"), (model.movies, "_q"))]
    return error + lam * sum(sizes)
