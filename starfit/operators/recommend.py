"""Best unseen movies per user under an additive model.

A user's own effect shifts all their predictions alike, so every user ranks the movies in
one and the same order and only skips what they have seen. That holds for levels keyed by the
user alone or by the movie and its genres. The ranking is served block by block until each user
has enough, which makes pairing users with all movies needless. Under a level of user and genres
each user merges shifted lists instead (``ranked_lists``); models with other levels are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfit.functions import or_zero
from starfit.operators.effects import EffectsModel, Level
from starfit.operators.keyed import KeyedTable, attach
from starfit.operators.ranked_lists import LIST, recommend_from_lists
from starfit.sources.staging import stage

# A block is the most that is sorted by one task or held per user at a time.
_GROWTH = 8
MAX_BLOCK = 500_000


def recommend(
    seen: DataFrame,
    model: EffectsModel,
    n: int,
    first_block: int | None = None,
    max_block: int = MAX_BLOCK,
    digits: int = 9,
) -> DataFrame:
    """userId, rank, movieId and prediction of the n best movies each user has not rated.

    ``seen`` has userId, movieId and genres; a movie with several genres has the smallest.
    Scores equal to ``digits`` places tie in the ranking, and the smaller movie id goes first;
    predictions are not rounded. Nearly all users are served by the first block; the few who
    have seen too much of it wait for the next ones.
    """
    for level in model.levels:
        if set(level.keys) not in ({"userId"}, set(LIST)) and not set(level.keys) <= {"movieId", "genres"}:
            raise ValueError(f"users rank movies differently under a level of {', '.join(level.keys)}")
    if any(set(level.keys) == set(LIST) for level in model.levels):
        return recommend_from_lists(seen, model, n, digits)
    scored = _scores(seen, model, digits)
    waiting = stage(seen.select("userId").distinct().withColumn("_need", F.lit(n)), "users")
    served: list[DataFrame] = []
    size = min(first_block or 4 * n, max_block)
    while True:
        block = KeyedTable.write(_head(scored, size), ["movieId"], "ranking-block")
        if block.n_rows == 0:
            break
        offered = stage(_offer(seen, waiting, block, is_first=not served), "offers")
        served.append(_picks(offered, block, n))
        waiting = offered.select("userId", (F.col("_need") - F.size("_places")).alias("_need"))
        waiting = waiting.filter("_need > 0")
        if block.n_rows < size or waiting.isEmpty():
            break
        last = block.frame.filter(F.col("_place") == size).first()
        scored = scored.filter(
            (F.col("_score") < last["_score"])
            | ((F.col("_score") == last["_score"]) & (F.col("movieId") > last["movieId"]))
        )
        size = min(size * _GROWTH, max_block)
    if not served:
        raise ValueError("no movies to recommend")
    found = served[0]
    for more in served[1:]:
        found = found.unionByName(more)
    own = [level for level in model.levels if level.keys == ("userId",)]
    pred = sum((or_zero(F.col(level.effect)) for level in own), F.lit(model.mu)) + F.col("_exact")
    return attach(found, [_table(model, level) for level in own]).select(
        "userId", "rank", "movieId", pred.alias("pred")
    )


def _scores(seen: DataFrame, model: EffectsModel, digits: int) -> DataFrame:
    movies = seen.filter("movieId IS NOT NULL").groupBy("movieId").agg(F.min("genres").alias("genres"))
    shared = [level for level in model.levels if level.keys != ("userId",)]
    effects = attach(movies, [_table(model, level) for level in shared])
    exact = sum((or_zero(F.col(level.effect)) for level in shared), F.lit(0.0))
    scored = effects.select("movieId", exact.alias("_exact"), F.round(exact, digits).alias("_score"))
    return stage(scored, "movie-scores")


def _head(scored: DataFrame, size: int) -> DataFrame:
    """The first ``size`` movies with their place."""
    order = [F.desc("_score"), F.asc("movieId")]
    place = F.row_number().over(Window.orderBy(*order))
    return scored.orderBy(*order).limit(size).withColumn("_place", place)


def _offer(seen: DataFrame, waiting: DataFrame, block: KeyedTable, is_first: bool) -> DataFrame:
    """Waiting users with the first places of the block that they still need and are free."""
    rated = seen.select("userId", "movieId")
    if not is_first:
        names = KeyedTable.write(
            waiting.select("userId", F.lit(True).alias("_waits")), ["userId"], "waiting-users"
        )
        rated = attach(rated, [names]).filter("_waits").drop("_waits")
    hits = (
        attach(rated, [block])
        .filter("_place IS NOT NULL")
        .select("userId", "_place")
        .distinct()
        .groupBy("userId")
        .agg(F.collect_list("_place").alias("_seen"))  # at most the places of a block
    )
    hits = KeyedTable.write(hits, ["userId"], "seen-in-block")
    taken = F.coalesce("_seen", F.array().cast("array<int>"))
    # The places needed are among the first so many: each seen one moves them on by one.
    last = F.least(F.col("_need") + F.size(taken), F.lit(block.n_rows))
    free = F.array_except(F.sequence(F.lit(1), last), taken)
    return attach(waiting, [hits]).select(
        "userId", "_need", F.slice(free, F.lit(1), F.col("_need")).alias("_places")
    )


def _picks(offered: DataFrame, block: KeyedTable, n: int) -> DataFrame:
    picked = offered.select("userId", "_need", F.posexplode("_places").alias("_i", "_place"))
    by_place = KeyedTable(block.frame, ("_place",), block.n_rows, block.n_bytes)
    rank = (F.lit(n) - F.col("_need") + F.col("_i") + 1).cast("bigint")
    return attach(picked, [by_place]).select("userId", rank.alias("rank"), "movieId", "_exact")


def _table(model: EffectsModel, level: Level) -> KeyedTable:
    return model.tables[model.levels.index(level)].with_values(level.effect)
