"""Exact best unseen movies per user under latent factors, without scoring all pairs.

A movie's score for a user is its shared effect plus the product of both factor vectors. By Cauchy
and Schwarz the product is at most the product of the vectors' lengths. Movies are ordered by
shared effect plus a typical user's length times their own length, their promise, and cut into
blocks; for a user, no movie of a block scores more than the block's largest promise plus what the
user's length differs from the typical one, times the block's largest or smallest length. A user is
served block by block, and has done when no block to come can reach the n-th best score so far.

Blocks are handed out in chunks of bounded bytes. Users are spread over the cluster and score a
block as one matrix product; those not done after a chunk go on with the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.functions import or_zero
from starfit.operators.factors import FactorModel
from starfit.operators.keyed import KeyedTable, attach
from starfit.operators.prefix import placed
from starfit.sources.staging import stage

#: Movies whose scores are worked out together.
BLOCK_MOVIES = 1_024
#: Bytes of movies handed to every task at once.
CHUNK_BYTES = 32 << 20
#: Users scored together.
_USERS = 512
#: Scores this close are taken as possibly equal when a user is to stop.
_SLACK = 1e-7

_STATE = "userId bigint, p array<double>, movies array<bigint>, scores array<double>, blocks int, open boolean"


def _movies(seen: DataFrame, model: FactorModel, typical: float) -> DataFrame:
    """movieId, q, shared effect and place of every movie, the most promising first. Written."""
    movies = seen.filter("movieId IS NOT NULL").groupBy("movieId").agg(F.min("genres").alias("genres"))
    base = model.base
    levels = [level for level in base.levels if level.keys != ("userId",)]
    if any("userId" in level.keys for level in levels):
        raise ValueError("users rank movies differently under the model below the factors")
    tables = [base.tables[base.levels.index(level)].with_values(level.effect) for level in levels]
    joined = attach(movies, [*tables, model.movies])
    none = F.array(*[F.lit(0.0)] * model.rank)
    shared = sum((or_zero(F.col(level.effect)) for level in levels), F.lit(0.0))
    rows = joined.select("movieId", F.coalesce("_q", none).alias("q"), shared.alias("shared"))
    rows = rows.withColumn("length", _length("q"))
    rows = rows.withColumn("_down", -(F.col("shared") + F.lit(typical) * F.col("length"))).withColumn("_all", F.lit(0))
    return stage(placed(stage(rows, "movies"), ["_all"], "_down", ["movieId"], "place").drop("_all", "_down"), "movie-order")


def _length(column: str):
    return F.sqrt(F.aggregate(column, F.lit(0.0), lambda a, x: a + x * x))


def _at_most(own: np.ndarray, typical: float, promise, least, most) -> np.ndarray:
    """The most that movies score for users of length ``own``, whose shared effect plus ``typical``
    times their length is at most ``promise`` and whose lengths lie between ``least`` and ``most``."""
    more = own - typical
    return promise + np.maximum(more * least, more * most)


def _merged(scores: np.ndarray, movies: np.ndarray, row: np.ndarray, name: np.ndarray, value: np.ndarray) -> None:
    """Put movies ``name`` of users ``row`` among the users' best, in place."""
    n = scores.shape[1]
    some = np.unique(row)
    old = np.repeat(some, n)
    user = np.concatenate([old, row])
    names = np.concatenate([movies[some].ravel(), name])
    values = np.concatenate([scores[some].ravel(), value])
    order = np.lexsort((names, -values, user))
    user = user[order]
    rank = np.arange(len(user)) - np.searchsorted(user, user)
    first = order[rank < n]
    scores[some], movies[some] = values[first].reshape(-1, n), names[first].reshape(-1, n)


def serve(
    p: np.ndarray,
    best: list[tuple[np.ndarray, np.ndarray]],
    seen: list[np.ndarray],
    chunk: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
    typical: float,
    later: tuple[float, float, float],
    n: int,
    block: int,
    digits: int,
) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Bring users' best (movies, scores) up to date with a chunk of (ids, q, shared, lengths).

    ``seen`` are places within the chunk. Returns also how many blocks each user read, and
    whether movies ``later``, of so large a promise and of lengths between these, may still
    matter; without later movies the promise is minus infinity.
    """
    ids, q, shared, lengths = chunk
    starts = np.arange(0, len(ids), block)
    own = np.linalg.norm(p, axis=1)
    promise = np.maximum.reduceat(shared + typical * lengths, starts)
    ends = np.minimum.reduceat(lengths, starts), np.maximum.reduceat(lengths, starts)
    ahead = np.column_stack([_at_most(own[:, None], typical, promise, *ends), _at_most(own, typical, *later)])
    ahead = np.maximum.accumulate(ahead[:, ::-1], axis=1)[:, ::-1]  # the most that any block from here on holds
    movies, scores = np.full((len(p), n), np.iinfo(np.int64).max), np.full((len(p), n), -np.inf)
    for k, (m, s) in enumerate(best):
        movies[k, : len(m)], scores[k, : len(s)] = m, s
    read = np.zeros(len(p), np.int64)
    user = np.repeat(np.arange(len(p)), [len(s) for s in seen])
    place = np.concatenate([*seen, np.zeros(0, np.int64)]).astype(np.int64)
    by_place = np.argsort(place, kind="stable")
    user, place = user[by_place], place[by_place]
    for b, start in enumerate(starts):
        at = np.flatnonzero(ahead[:, b] >= scores[:, -1] - _SLACK)
        if len(at) == 0:
            break
        stop = min(start + block, len(ids))
        found = p[at] @ q[start:stop].T
        found += shared[start:stop]
        line = np.full(len(p), -1)
        line[at] = np.arange(len(at))
        first, last = np.searchsorted(place, [start, stop])
        hidden = np.arange(first, last)[line[user[first:last]] >= 0]
        found[line[user[hidden]], place[hidden] - start] = -np.inf
        # Only what may be among the n best, as rounded, is put in order.
        least = scores[at, -1]
        short = np.flatnonzero(least == -np.inf)
        if len(short) and stop - start > n:
            least[short] = np.partition(found[short], -n, axis=1)[:, -n]
        row, column = np.nonzero(found >= np.maximum(least - 2 * 10.0**-digits, np.finfo(float).min)[:, None])
        if len(row):
            _merged(scores, movies, at[row], ids[start + column], np.round(found[row, column], digits))
        read[at] += 1
    going = (ahead[:, -1] >= scores[:, -1] - _SLACK) & np.isfinite(later[0])
    kept = [(m[s > -np.inf], s[s > -np.inf]) for m, s in zip(movies, scores)]
    return kept, read, going


def recommend_by_factors(
    seen: DataFrame,
    model: FactorModel,
    n: int,
    digits: int = 9,
    block: int = BLOCK_MOVIES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """userId, rank, movieId, pred and ``blocks``, how many of the blocks of movies the user read.

    Scores count to ``digits`` places; equal ones go by the smaller movie id.
    """
    spark = seen.sparkSession
    typical = model.users.frame.agg(F.avg(_length("_p"))).first()[0] or 0.0
    order = _movies(seen, model, typical)
    size = max(block, chunk_bytes // (8 * (model.rank + 4)) // block * block)
    bounds = order.groupBy(F.floor((F.col("place") - 1) / size).cast("int").alias("chunk")).agg(
        F.max(F.col("shared") + F.lit(typical) * F.col("length")).alias("promise"),
        F.min("length").alias("least"),
        F.max("length").alias("most"),
    )
    chunks = sorted((r.chunk, r.promise, r.least, r.most) for r in bounds.collect())  # one row for 32 MB of movies
    by_movie = KeyedTable.measure(order.select("movieId", "place"), ["movieId"])
    pairs = seen.select(F.col("userId").cast("bigint").alias("userId"), "movieId").distinct()
    watched = stage(attach(pairs, [by_movie]).filter("place IS NOT NULL").select("userId", "place"), "seen-places")

    zero = F.array(*[F.lit(0.0)] * model.rank)
    users = attach(pairs.select("userId").distinct(), [model.users])
    empty = F.array().cast("array<bigint>").alias("movies"), F.array().cast("array<double>").alias("scores")
    state = users.select("userId", F.coalesce("_p", zero).alias("p"), *empty, F.lit(0).alias("blocks"), F.lit(True).alias("open"))
    state = stage(state, "users")
    done: list[DataFrame] = []
    for k, *_ in chunks:
        lines = order.filter((F.col("place") > k * size) & (F.col("place") <= (k + 1) * size)).orderBy("place")
        table = lines.select("movieId", "q", "shared", "length").toArrow()  # chunk_bytes
        chunk = (
            table["movieId"].to_numpy().astype(np.int64),
            table["q"].combine_chunks().flatten().to_numpy().reshape(-1, model.rank),
            table["shared"].to_numpy(),
            table["length"].to_numpy(),
        )
        promises, least, most = zip(*([x[1:] for x in chunks if x[0] > k] or [(-np.inf, 0.0, 0.0)]))
        later = max(promises), min(least), max(most)
        state = stage(_served(state, watched, chunk, typical, later, k * size, size, n, block, digits), "users-served")
        done.append(state.filter("NOT open"))
        state = state.filter("open")
        if k + 1 < len(chunks) and state.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    listed = out.select("userId", "blocks", F.posexplode(F.arrays_zip("movies", "scores")).alias("_i", "_x"))
    personal = [level for level in model.base.levels if level.keys == ("userId",)]
    tables = [model.base.tables[model.base.levels.index(level)].with_values(level.effect) for level in personal]
    pred = sum((or_zero(F.col(level.effect)) for level in personal), F.lit(model.base.mu)) + F.col("_x.scores")
    return attach(listed, tables).select(
        "userId", (F.col("_i") + 1).cast("bigint").alias("rank"), F.col("_x.movies").alias("movieId"), pred.alias("pred"), "blocks"
    )


def _served(
    state: DataFrame,
    watched: DataFrame,
    chunk: tuple,
    typical: float,
    later: tuple[float, float, float],
    first: int,
    size: int,
    n: int,
    block: int,
    digits: int,
) -> DataFrame:
    here = watched.filter((F.col("place") > first) & (F.col("place") <= first + size))
    # At most as many places as a chunk has movies.
    hidden = here.groupBy("userId").agg(F.collect_list((F.col("place") - first - 1).cast("bigint")).alias("_seen"))
    hidden = hidden.withColumnRenamed("userId", "_user")
    joined = state.join(hidden, F.col("userId").eqNullSafe(F.col("_user")), "left").select(
        *[x.split()[0] for x in _STATE.split(", ")], F.coalesce("_seen", F.array().cast("array<bigint>")).alias("_seen")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _USERS):
                batch = whole.slice(at, _USERS)
                column = dict(zip(batch.schema.names, batch.columns))
                p = np.array(column["p"].to_pylist(), np.float64)
                lists = [[np.array(x) for x in column[c].to_pylist()] for c in ("movies", "scores", "_seen")]
                best = list(zip(lists[0], lists[1]))
                kept, read, going = serve(p, best, lists[2], chunk, typical, later, n, block, digits)
                yield pa.RecordBatch.from_arrays(
                    [
                        column["userId"],
                        column["p"],
                        pa.array([m.tolist() for m, _ in kept], pa.list_(pa.int64())),
                        pa.array([s.tolist() for _, s in kept], pa.list_(pa.float64())),
                        pa.array(column["blocks"].to_numpy() + read, pa.int32()),
                        pa.array(going),
                    ],
                    names=[x.split()[0] for x in _STATE.split(", ")],
                )

    return joined.mapInArrow(run, _STATE)
