"""Best unseen movies per user where users rank genres differently.

With an effect per user and genre string, two users order the movies of one genre string alike
and only move the whole list up or down. So there is one ranked list per genre string, and a
user's result is a merge of shifted lists, never a pairing of users with movies:

1. A user has a list of their own for every genre string they have an effect for or have seen
   a movie of. Of all other strings only those with the n best first movies can matter, so n of
   them are taken from one ranking of first movies that all users share.
2. The first unseen movie of each list is its head. The n lists with the best heads are kept: any
   other movie is behind n heads. Of the r-th list n + 1 - r movies are enough, since r - 1 heads
   are before all of it.
3. The movies so left, at most n(n + 1)/2 a user, are ranked.

What a user has seen parts a list into stretches of unseen movies; these are worked out with
running counts, so neither a list nor what a user has seen of it is held in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfit.functions import or_zero
from starfit.operators.effects import EffectsModel, Level
from starfit.operators.keyed import KeyedTable, attach, same_key
from starfit.operators.prefix import placed, sums_before
from starfit.sources.staging import stage

LIST = ["userId", "genres"]


def units(score: Column, digits: int) -> Column:
    """Scores as whole numbers of the last digit, so that shifted lists keep their order."""
    return F.round(score * F.lit(10.0**digits)).cast("bigint")


def _table(model: EffectsModel, level: Level) -> KeyedTable:
    return model.tables[model.levels.index(level)].with_values(level.effect)


def _sum(levels: Sequence[Level]) -> Column:
    return sum((or_zero(F.col(level.effect)) for level in levels), F.lit(0.0))


def _ranking(seen: DataFrame, model: EffectsModel, shared: Sequence[Level], digits: int) -> DataFrame:
    """genres, place, movieId, units and exact score of every movie, best of its genres first."""
    movies = seen.filter("movieId IS NOT NULL").groupBy("movieId").agg(F.min("genres").alias("genres"))
    scored = attach(movies, [_table(model, level) for level in shared])
    scored = scored.select("movieId", "genres", _sum(shared).alias("_exact")).withColumn(
        "_units", units(F.col("_exact"), digits)
    )
    scored = stage(scored.withColumn("_down", -F.col("_units")), "movie-scores")
    return stage(placed(scored, ["genres"], "_down", ["movieId"], "_place").drop("_down"), "genre-lists")


def _unseen_stretches(watched: DataFrame, sizes: KeyedTable, n: int) -> DataFrame:
    """userId, genres, _from, _to, _skipped of the first unseen movies of lists with seen ones.

    A stretch holds the places from ``_from`` to ``_to``; ``_skipped`` unseen ones are before it.
    Stretches with n or more unseen places before them are left out.
    """
    watched = watched.withColumn("_one", F.lit(1).cast("bigint"))
    counted = sums_before(watched, LIST, "_place", ["_one"])
    start = F.coalesce("_place_before", F.lit(0)) + 1
    between = counted.select(
        *LIST, start.alias("_from"), (F.col("_place") - 1).alias("_to"), (start - 1 - F.col("_one_before")).alias("_skipped")
    )
    ends = attach(watched.groupBy(*LIST).agg(F.max("_place").alias("_last"), F.count("*").alias("_seen")), [sizes])
    tails = ends.select(
        *LIST,
        (F.col("_last") + 1).alias("_from"),
        F.col("_size").alias("_to"),
        (F.col("_last") - F.col("_seen")).alias("_skipped"),
    )
    return between.unionByName(tails).filter((F.col("_from") <= F.col("_to")) & (F.col("_skipped") < n))


def _own_lists(met: DataFrame, users: DataFrame, model: EffectsModel, own: Sequence[Level], ranking: DataFrame) -> DataFrame:
    """userId, genres and _shift of the lists that a user has an effect for or has seen from."""
    users = KeyedTable.measure(users.withColumn("_asks", F.lit(True)), ["userId"])
    for level in own:
        felt = attach(model.effects(level).select(*LIST), [users]).filter("_asks")
        met = met.unionByName(felt.select(*LIST))
    listed = ranking.select("genres").distinct().withColumn("_listed", F.lit(True))
    known = KeyedTable.write(listed, ["genres"], "listed")
    lists = attach(met.distinct(), [known, *(_table(model, level) for level in own)]).filter("_listed")
    return lists.select(*LIST, _sum(own).alias("_shift"))


def _other_lists(users: DataFrame, lists: DataFrame, heads: DataFrame, n: int) -> DataFrame:
    """userId and genres of the n lists with the best first movies among those not a user's own."""
    by_genres = KeyedTable.measure(heads.select("genres", "_order"), ["genres"])
    taken = attach(lists.select(*LIST), [by_genres]).groupBy("userId")
    # At most as many places as there are genre strings.
    taken = KeyedTable.write(taken.agg(F.collect_list("_order").alias("_taken")), ["userId"], "own-lists")
    n_lists = by_genres.n_rows
    of_user = attach(users, [taken]).withColumn("_taken", F.coalesce("_taken", F.array().cast("array<bigint>")))
    last = F.least(F.lit(n) + F.size("_taken"), F.lit(n_lists)).cast("bigint")
    free = F.slice(F.array_except(F.sequence(F.lit(1).cast("bigint"), last), F.col("_taken")), 1, n)
    picked = of_user.select("userId", F.explode(free).alias("_order"))
    by_order = KeyedTable(heads.select("_order", "genres"), ("_order",), by_genres.n_rows, by_genres.n_bytes)
    return attach(picked, [by_order]).select(*LIST)


def recommend_from_lists(seen: DataFrame, model: EffectsModel, n: int, digits: int = 9) -> DataFrame:
    """userId, rank, movieId and prediction of the n best movies each user has not rated.

    The model's levels are keyed by the user, by the movie and its genres, or by the user and
    the genres. Scores count in whole units of ``digits`` places, shared part and shift apart;
    equal ones go by the smaller movie id. Predictions are not rounded.
    """
    own = [level for level in model.levels if set(level.keys) == set(LIST)]
    shared = [level for level in model.levels if set(level.keys) <= {"movieId", "genres"}]
    ranking = _ranking(seen, model, shared, digits)
    by_movie = KeyedTable.measure(ranking.select("movieId", "genres", "_place"), ["movieId"])
    sizes = KeyedTable.write(ranking.groupBy("genres").agg(F.count("*").alias("_size")), ["genres"], "list-sizes")
    heads = ranking.filter("_place = 1").select(
        "genres", "movieId", (-F.col("_units")).alias("_down"), F.lit(0).alias("_all")
    )
    heads = stage(placed(stage(heads, "heads"), ["_all"], "_down", ["movieId"], "_order"), "list-order")

    users = stage(seen.select("userId").distinct(), "users")
    met = attach(seen.select("userId", "movieId").distinct(), [by_movie]).select(*LIST, "_place")
    met = stage(met, "seen-places")
    watched = met.filter("_place IS NOT NULL")
    # Looked up once: what is seen tells a user's lists, their stretches and which are untouched.
    lists = stage(_own_lists(met.select(*LIST), users, model, own, ranking), "own-lists")
    stretches = stage(_unseen_stretches(watched, sizes, n), "unseen")

    # Lists without a seen movie are one stretch.
    touched = KeyedTable.write(
        watched.select(*LIST, F.lit(True).alias("_touched")).distinct(),
        LIST,
        "touched",
    )
    untouched = attach(lists, [touched]).filter("_touched IS NULL").select(*LIST, "_shift")
    others = _other_lists(users, lists, heads, n).withColumn("_shift", F.lit(0.0))
    whole = attach(untouched.unionByName(others), [sizes]).select(
        *LIST, "_shift", F.lit(1).cast("bigint").alias("_from"), F.col("_size").alias("_to"), F.lit(0).cast("bigint").alias("_skipped")
    )
    shifts = KeyedTable.measure(lists, LIST)
    parted = attach(stretches, [shifts]).select(*LIST, "_shift", "_from", "_to", "_skipped")
    every = stage(parted.unionByName(whole), "stretches")

    by_place = KeyedTable.measure(ranking.select("genres", "_place", "movieId", "_units", "_exact"), ["genres", "_place"])
    scored = F.col("_units") + units(F.col("_shift"), digits)
    first = attach(every.filter("_skipped = 0").withColumnRenamed("_from", "_place"), [by_place])
    best = Window.partitionBy("userId").orderBy(F.desc("_score"), F.asc("movieId"))
    kept = first.withColumn("_score", scored).select(*LIST, F.row_number().over(best).alias("_r"))
    kept = stage(kept.filter(F.col("_r") <= n).withColumn("_need", F.lit(n + 1) - F.col("_r")), "kept-lists")

    named = kept.select(F.col("userId").alias("_u"), F.col("genres").alias("_g"), "_need")
    on = same_key([every["userId"], every["genres"]], [named["_u"], named["_g"]])
    # Up to n lists a user, whose files are small: without the hint Spark may broadcast them.
    wanted = every.join(named.hint("merge"), on & (every["_skipped"] < named["_need"]))
    last = F.least(F.col("_to"), F.col("_from") + F.col("_need") - F.col("_skipped") - 1)
    places = wanted.select(*LIST, "_shift", F.explode(F.sequence("_from", last)).alias("_place"))
    offered = attach(places, [by_place]).withColumn("_score", scored)
    ranked = offered.withColumn("rank", F.row_number().over(best).cast("bigint")).filter(F.col("rank") <= n)
    personal = [level for level in model.levels if set(level.keys) == {"userId"}]
    pred = F.lit(model.mu) + _sum(personal) + F.col("_exact") + F.col("_shift")
    return attach(ranked, [_table(model, level) for level in personal]).select(
        "userId", "rank", "movieId", pred.alias("pred")
    )
