"""What a movie's genre words say about its ratings, and priors for movies with few or none.

``GenreWords`` regresses what a model leaves over on the words of the genre string, each rating a
row with a one for each of its movie's words. The normal equations need no such rows: ratings are
summed up per genre string first, and a string adds its count to every pair of its words. They are
solved once for all words. ``MoviePrior`` blends a movie's own mean with what its words say, by
variances estimated from moments.

A missing genre string is a word of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfit.functions import or_zero
from starfit.operators.effects import PREDICTION, RATING, EffectsModel
from starfit.operators.keyed import SMALL_BYTES, KeyedTable, attach
from starfit.sources.staging import stage

#: Distinct words whose equations are solved together, 128 MB of them; more are refused.
MOST_WORDS = 4_000


def words_of(genres: Column) -> Column:
    """Distinct words of a genre string; a missing string is one missing word."""
    return F.when(genres.isNull(), F.array(F.lit(None).cast("string"))).otherwise(
        F.array_distinct(F.split(genres, "[|]"))
    )


def word_weights(sums: DataFrame, lam: float) -> DataFrame:
    """word, weight and n from ``genres``, ``n`` and ``s``: count and sum of the string's ratings."""
    spark = sums.sparkSession
    worded = stage(sums.select(words_of(F.col("genres")).alias("words"), "n", "s"), "genre-words")
    each = worded.select(F.explode("words").alias("word"), "n", "s").groupBy("word")
    words = each.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy(F.asc_nulls_first("word"))
    words = words.limit(MOST_WORDS + 1).collect()
    if len(words) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} distinct genre words")
    pairs = worded.select("words", F.explode("words").alias("a"), "n").select("a", F.explode("words").alias("b"), "n")
    place = {r.word: k for k, r in enumerate(words)}
    gram = float(lam) * np.eye(len(words))
    for r in pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).toLocalIterator():  # words squared
        gram[place[r.a], place[r.b]] += r.n
    sides = np.array([r.s for r in words], np.float64)
    # Without a penalty, words that always come together have no weights of their own.
    weights = np.linalg.solve(gram, sides) if lam > 0 else np.linalg.lstsq(gram, sides, rcond=None)[0]
    rows = [(r.word, float(w), r.n) for r, w in zip(words, weights)]
    return stage(spark.createDataFrame(rows, "word string, weight double, n bigint"), "word-weights")


def string_effects(genres: DataFrame, weights: DataFrame, name: str) -> KeyedTable:
    """The sum of the words' weights of every distinct ``genres``; unknown words weigh nothing."""
    strings = genres.select("genres").distinct()
    each = strings.select("genres", F.explode(words_of(F.col("genres"))).alias("_w"))
    known = weights.select("word", "weight")
    # Fewer words than MOST_WORDS.
    joined = each.join(F.broadcast(known), F.col("_w").eqNullSafe(F.col("word")), "left")
    return KeyedTable.write(joined.groupBy("genres").agg(F.sum(or_zero(F.col("weight"))).alias(name)), ["genres"], name)


@dataclass(frozen=True)
class GenreWords:
    """A weight per genre word on top of a model. ``weights``: word, weight, n."""

    base: EffectsModel
    weights: DataFrame

    @staticmethod
    def fit(train: DataFrame, base: EffectsModel, lam: float, small_bytes: int = SMALL_BYTES) -> GenreWords:
        columns = dict.fromkeys(["genres", *base.reads, RATING])
        scored = base.predict(train.select(*columns), small_bytes)
        left = F.sum(F.col(RATING) - F.col(PREDICTION))
        return GenreWords(base, word_weights(scored.groupBy("genres").agg(F.count("*").alias("n"), left.alias("s")), lam))

    def predict(self, rows: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
        """The model's prediction plus ``b_w``, also for strings that training never saw."""
        table = string_effects(rows, self.weights, "b_w")
        joined = attach(self.base.predict(rows, small_bytes), [table], small_bytes)
        return joined.withColumn("b_w", or_zero(F.col("b_w"))).withColumn(PREDICTION, F.col(PREDICTION) + F.col("b_w"))


@dataclass(frozen=True)
class MoviePrior:
    """Movie effects drawn towards what the movies' genre words say.

    A movie's mean of ``rating - mu`` varies around its words' sum with variance ``between``, a
    rating around the movie's mean with variance ``within``. ``movies``: movieId, n_i and b_i.
    """

    mu: float
    within: float
    between: float
    weights: DataFrame
    movies: KeyedTable

    @staticmethod
    def fit(train: DataFrame, lam: float, small_bytes: int = SMALL_BYTES) -> MoviePrior:
        mu = train.agg(F.avg(RATING)).first()[0] or 0.0
        rows = train.select("movieId", "genres", (F.col(RATING) - F.lit(mu)).alias("_r"))
        by_string = rows.groupBy("genres").agg(F.count("*").alias("n"), F.sum("_r").alias("s"))
        weights = word_weights(by_string, lam)
        # A movie with several strings has the smallest; a missing one comes last.
        movies = rows.groupBy("movieId").agg(
            F.count("*").alias("n_i"),
            F.avg("_r").alias("_mean"),
            F.var_pop("_r").alias("_var"),
            F.min("genres").alias("genres"),
        )
        movies = stage(movies, "movie-means")
        told = attach(movies, [string_effects(movies, weights, "_said")], small_bytes)
        said = or_zero(F.col("_said"))
        off = F.col("_mean") - said
        sums = told.agg(
            F.count("*").alias("m"),
            F.sum("n_i").alias("n"),
            F.sum(F.col("n_i") * F.col("_var")).alias("inside"),
            F.sum(F.col("n_i") * off * off).alias("outside"),
        ).first()
        within = sums.inside / (sums.n - sums.m) if sums.n and sums.n > sums.m else 0.0
        between = max(0.0, (sums.outside - sums.m * within) / sums.n) if sums.n else 0.0
        trust = F.lit(between) * F.col("n_i") / (F.lit(between) * F.col("n_i") + F.lit(within))
        blend = said + F.when(F.lit(between + within) > 0, trust).otherwise(F.lit(1.0)) * off
        table = KeyedTable.write(told.select("movieId", "n_i", blend.alias("b_i")), ["movieId"], "movie-prior")
        return MoviePrior(mu, within, between, weights, table)

    def predict(self, rows: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
        """``n_i``, ``b_i`` and the prediction; unseen movies have what their words say."""
        joined = attach(rows, [self.movies, string_effects(rows, self.weights, "_said")], small_bytes)
        effect = F.coalesce("b_i", "_said", F.lit(0.0))
        return (
            joined.withColumns({"b_i": effect, "n_i": F.coalesce("n_i", F.lit(0))})
            .withColumn(PREDICTION, F.lit(self.mu) + F.col("b_i"))
            .drop("_said")
        )


def errors_by_support(rows: DataFrame, few: int) -> DataFrame:
    """Errors of a plain movie model (``plain``) and of the prior, by ratings of the movie.

    ``rows``: rating, n_i, pred and plain. Movies are unseen, have up to ``few`` ratings, or more.
    """
    support = F.when(F.col("n_i") == 0, "unseen").when(F.col("n_i") <= few, "few").otherwise("many")
    error = lambda c: F.sqrt(F.avg((F.col(RATING) - F.col(c)) ** 2))
    return rows.groupBy(support.alias("support")).agg(
        F.count("*").alias("n"), error("plain").alias("rmse_plain"), error(PREDICTION).alias("rmse_prior")
    )
