"""Every query by name, over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfit.operators import diagnostics, effects, explore
from starfit.operators.activity import GENRE_ACTIVITY, MOVIE_ACTIVITY, USER_ACTIVITY, point_in_time
from starfit.operators.backtest import backtest, time_origins
from starfit.operators.blend import blend_weights, blended, out_of_fold
from starfit.operators.content import MoviePrior, errors_by_support
from starfit.operators.effects import GENRE, MOVIE, USER, USER_GENRE, EffectsModel
from starfit.operators.inner_product import recommend_by_factors
from starfit.operators.partition import known_to_rest
from starfit.operators.recommend import recommend
from starfit.operators.timed import MovieBins
from starfit.operators.titles import similar_titles as most_similar_titles
from starfit.plans.ladder import BIN_WIDTH, LEVELS, WORDS_LAMBDA
from starfit.plans.workbench import Workbench, workbench
from starfit.sources import staging_path
from starfit.sources.delimited import (
    MOVIE_FIELDS,
    RATING_FIELDS,
    SEPARATOR,
    Parsed,
    read_delimited,
    write_delimited,
)
from starfit.sources.testtables import ENRICHED_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

# The genre words of the given tables.
GENRE_WORDS = ("PROMO", "LARGE", "SMALL", "ECONOMY")
FIXED_LAMBDA = 5.0

_QUERIES: dict[str, Callable[[Workbench], DataFrame]] = {}


def query(function: Callable[[Workbench], DataFrame]) -> Callable[[Workbench], DataFrame]:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    def bind(function: Callable[[Workbench], DataFrame]) -> Query:
        return lambda spark, sf_dir: function(workbench(spark, sf_dir))

    return {name: bind(function) for name, function in _QUERIES.items()}


def _tidy(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Fractions rounded, and negative zero made zero."""
    return frame.select(
        *[
            (F.round(c, digits) + F.lit(0.0)).alias(c) if kind == "double" else F.col(c)
            for c, kind in frame.dtypes
        ]
    )


# ---- Reading and enriching


@query
def scan_ratings(w: Workbench) -> DataFrame:
    path = staging_path(w.spark, "ratings-text")
    write_delimited(w.ratings, path, [name for name, _ in RATING_FIELDS])
    return read_delimited(w.spark, path, RATING_FIELDS).good


@query
def scan_movies(w: Workbench) -> DataFrame:
    path = staging_path(w.spark, "movies-text")
    write_delimited(w.movies, path, [name for name, _ in MOVIE_FIELDS])
    return read_delimited(w.spark, path, MOVIE_FIELDS).good


def _messy_ratings(w: Workbench) -> Parsed:
    """The ratings as text in which most lines are odd or broken, depending on their number."""
    number = F.col("line_number")
    movie = F.col("movieId").cast("string")
    stamp = F.col("timestamp").cast("string")
    rating = F.col("rating").cast("string")
    kind = F.col("movieId") % 10
    lines = w.ratings.select(
        F.concat_ws(
            SEPARATOR,
            F.col("userId").cast("string"),
            F.when(number == 2, F.concat(movie, F.lit(".7")))
            .when(number == 3, F.concat(movie, F.lit("e0")))
            .when(number == 4, F.concat(F.lit("n"), movie))
            .otherwise(movie),
            F.when(number == 5, "")
            .when((number == 1) & (kind == 0), F.concat(rating, F.lit("f")))
            .when((number == 1) & (kind == 1), F.concat(rating, F.lit("d")))
            .when((number == 1) & (kind == 2), "Infinity")
            .when((number == 1) & (kind == 3), "1e400")
            .otherwise(rating),
            F.when(number == 6, None)
            .when(number == 7, F.concat(stamp, F.lit(SEPARATOR + "x")))
            .otherwise(stamp),
        ).alias("value")
    )
    path = staging_path(w.spark, "messy-text")
    lines.write.text(path)
    return read_delimited(w.spark, path, RATING_FIELDS)


@query
def typed_ratings(w: Workbench) -> DataFrame:
    return _messy_ratings(w).good


@query
def rejected_ratings(w: Workbench) -> DataFrame:
    return _messy_ratings(w).rejects


@query
def enrich_ratings(w: Workbench) -> DataFrame:
    return w.enriched.select(*ENRICHED_COLUMNS)


# ---- Partition


@query
def split_holdout(w: Workbench) -> DataFrame:
    return w.sparse_sample.filter("sampled").select(*ENRICHED_COLUMNS)


@query
def split_validation(w: Workbench) -> DataFrame:
    return w.sparse.validation.select(*ENRICHED_COLUMNS)


@query
def split_strata_counts(w: Workbench) -> DataFrame:
    return w.sparse_sample.groupBy("stratum").agg(
        F.count("*").alias("n"), F.count_if("sampled").alias("n_sampled")
    )


@query
def semi_known_movies(w: Workbench) -> DataFrame:
    known = known_to_rest(w.sparse_sample, ["movieId"])
    return known.filter("known_movieId").select(*ENRICHED_COLUMNS)


@query
def semi_known_users(w: Workbench) -> DataFrame:
    known = known_to_rest(w.sparse_sample, ["movieId", "userId"])
    return known.filter("known_movieId AND known_userId").select(*ENRICHED_COLUMNS)


@query
def anti_removed(w: Workbench) -> DataFrame:
    return w.sparse_repaired.removed.select(*ENRICHED_COLUMNS)


@query
def edx_repaired(w: Workbench) -> DataFrame:
    return w.sparse_repaired.development.select(*ENRICHED_COLUMNS)


@query
def holdout_repaired(w: Workbench) -> DataFrame:
    return w.sparse_repaired.holdout.select(*ENRICHED_COLUMNS)


@query
def partition_sizes(w: Workbench) -> DataFrame:
    sizes = [
        part.agg(F.lit(name).alias("part"), F.count("*").alias("n"))
        for name, part in (
            ("train", w.sparse.train),
            ("validation", w.sparse.validation),
            ("holdout", w.sparse.holdout),
        )
    ]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


# ---- Effects


@query
def global_mean(w: Workbench) -> DataFrame:
    return _tidy(effects.global_mean(w.dense.train))


def _effects(model: EffectsModel, level, with_count: bool = True) -> DataFrame:
    columns = [*level.keys, level.effect, *([level.count] if with_count else [])]
    return _tidy(model.effects(level).select(*columns))


@query
def movie_effects(w: Workbench) -> DataFrame:
    return _effects(w.ladder.fitted.at(0.0), MOVIE, with_count=False)


@query
def user_effects(w: Workbench) -> DataFrame:
    return _effects(w.ladder.user_only, USER, with_count=False)


@query
def user_effects_given_movie(w: Workbench) -> DataFrame:
    return _effects(w.ladder.combined, USER, with_count=False)


@query
def reg_movie_effects(w: Workbench) -> DataFrame:
    return _effects(w.ladder.fitted.at(FIXED_LAMBDA), MOVIE)


@query
def reg_user_effects(w: Workbench) -> DataFrame:
    return _effects(w.ladder.fitted.at(FIXED_LAMBDA), USER)


@query
def reg_genre_effects(w: Workbench) -> DataFrame:
    return _effects(w.ladder.fitted.at(FIXED_LAMBDA), GENRE)


@query
def final_movie_effects(w: Workbench) -> DataFrame:
    return _effects(w.ladder.final, MOVIE)


@query
def final_user_effects(w: Workbench) -> DataFrame:
    return _effects(w.ladder.final, USER)


@query
def final_genre_effects(w: Workbench) -> DataFrame:
    return _effects(w.ladder.final, GENRE)


@query
def effects_roundtrip(w: Workbench) -> DataFrame:
    path = staging_path(w.spark, "model")
    w.ladder.final.save(path)
    model = EffectsModel.load(w.spark, path, LEVELS)
    parts = [
        model.effects(level).select(
            F.lit(level.effect).alias("effect"),
            F.col(level.keys[0]).cast("string").alias("key"),
            F.col(level.effect).alias("value"),
            F.col(level.count).alias("n"),
        )
        for level in LEVELS
    ]
    return _tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _residuals(w: Workbench, model: EffectsModel, columns: Sequence[str]) -> DataFrame:
    """Training rows with the effects fitted so far and what they leave of the rating."""
    scored = model.predict(w.dense.train.select(*columns, "rating"))
    names = [level.effect for level in model.levels]
    residual = (F.col("rating") - F.col("pred")).alias("residual")
    return _tidy(scored.select(*columns, "rating", *names, residual))


@query
def fit_user_given_movie(w: Workbench) -> DataFrame:
    return _residuals(w, w.ladder.fitted.at(0.0).only(MOVIE), ["userId", "movieId"])


@query
def fit_genre_given_movie_user(w: Workbench) -> DataFrame:
    model = w.ladder.fitted.at(FIXED_LAMBDA).only(MOVIE, USER)
    return _residuals(w, model, ["userId", "movieId", "genres"])


# ---- Scoring


def _scored(rows: DataFrame, model: EffectsModel, columns: Sequence[str]) -> DataFrame:
    names = [level.effect for level in model.levels]
    keys = list(dict.fromkeys([*columns, *(k for level in model.levels for k in level.keys)]))
    scored = model.predict(rows.select(*keys, "rating"))
    return _tidy(scored.select(*columns, "rating", *names, "pred"))


@query
def score_baseline(w: Workbench) -> DataFrame:
    return _scored(w.dense.validation, w.ladder.combined.only(), ["userId", "movieId"])


@query
def score_movie(w: Workbench) -> DataFrame:
    return _scored(w.dense.validation, w.ladder.combined.only(MOVIE), ["userId", "movieId"])


@query
def score_user(w: Workbench) -> DataFrame:
    return _scored(w.dense.validation, w.ladder.user_only, ["userId", "movieId"])


@query
def score_combined(w: Workbench) -> DataFrame:
    return _scored(w.dense.validation, w.ladder.combined, ["userId", "movieId"])


@query
def score_regularized(w: Workbench) -> DataFrame:
    return _scored(w.dense.validation, w.ladder.regularized, ["userId", "movieId"])


@query
def score_full(w: Workbench) -> DataFrame:
    return _scored(w.dense.validation, w.ladder.final, ["userId", "movieId", "genres"])


@query
def score_holdout(w: Workbench) -> DataFrame:
    return _scored(w.dense.holdout, w.ladder.final, ["userId", "movieId", "genres"])


# ---- Errors


def _rmse(rows: DataFrame, model: EffectsModel) -> DataFrame:
    return _tidy(diagnostics.rmse_of(model.predict(rows)))


@query
def rmse_baseline(w: Workbench) -> DataFrame:
    return _rmse(w.dense.validation, w.ladder.combined.only())


@query
def rmse_movie(w: Workbench) -> DataFrame:
    return _rmse(w.dense.validation, w.ladder.combined.only(MOVIE))


@query
def rmse_user(w: Workbench) -> DataFrame:
    return _rmse(w.dense.validation, w.ladder.user_only)


@query
def rmse_combined(w: Workbench) -> DataFrame:
    return _rmse(w.dense.validation, w.ladder.combined)


@query
def rmse_regularized(w: Workbench) -> DataFrame:
    return _rmse(w.dense.validation, w.ladder.regularized)


@query
def rmse_final_validation(w: Workbench) -> DataFrame:
    return _rmse(w.dense.validation, w.ladder.final)


@query
def rmse_holdout(w: Workbench) -> DataFrame:
    return _rmse(w.dense.holdout, w.ladder.final)


@query
def lambda_curve_2level(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.curve(2))


@query
def lambda_curve_3level(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.curve(3))


@query
def lambda_curve_min(w: Workbench) -> DataFrame:
    curves = w.ladder.errors.filter("levels >= 2")
    return _tidy(curves.groupBy("levels").agg(F.min("rmse").alias("rmse")))


@query
def best_lambda(w: Workbench) -> DataFrame:
    best = [
        w.ladder.best(levels).select(F.lit(levels).alias("levels"), "lambda", "rmse")
        for levels in (2, 3)
    ]
    return _tidy(best[0].unionByName(best[1]))


@query
def model_comparison(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.comparison, digits=4)


@query
def improvement_over_baseline(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.improvements())


@query
def run_metrics(w: Workbench) -> DataFrame:
    return w.ladder.metrics()


# ---- Diagnostics


@query
def box_pred_by_rating(w: Workbench) -> DataFrame:
    return _tidy(diagnostics.box_by_rating(w.ladder.scored_holdout))


@query
def bias_by_rating(w: Workbench) -> DataFrame:
    return _tidy(diagnostics.bias_by_rating(w.ladder.scored_holdout))


@query
def pred_vs_actual_hist(w: Workbench) -> DataFrame:
    return diagnostics.histogram(w.ladder.scored_holdout)


@query
def pred_vs_actual_points(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.scored_holdout.select("rating", "pred"))


@query
def box_genre_effects(w: Workbench) -> DataFrame:
    return _tidy(diagnostics.effect_boxes(w.ladder.final, GENRE))


@query
def genre_effect_ranking(w: Workbench) -> DataFrame:
    return _tidy(diagnostics.effect_ranking(w.ladder.final, GENRE))


def _extremes(w: Workbench, worst: bool) -> DataFrame:
    found = diagnostics.extreme_errors(w.ladder.scored_holdout, 10, ["row_key"], worst)
    return _tidy(found.select("userId", "movieId", "rating", "pred", "abs_error"))


@query
def extreme_errors_worst(w: Workbench) -> DataFrame:
    return _extremes(w, worst=True)


@query
def extreme_errors_best(w: Workbench) -> DataFrame:
    return _extremes(w, worst=False)


@query
def effect_importance(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.importance())


# ---- Exploration


@query
def profile_table(w: Workbench) -> DataFrame:
    return explore.profile(
        w.dense.development.select(*ENRICHED_COLUMNS), ["userId", "movieId", "timestamp", "rating"]
    )


@query
def count_rating_eq(w: Workbench) -> DataFrame:
    return explore.count_equal(w.dense.development, "rating", [0, 3])


@query
def distinct_movies(w: Workbench) -> DataFrame:
    return explore.distinct_count(w.dense.development, "movieId", "n_movies")


@query
def distinct_users(w: Workbench) -> DataFrame:
    return explore.distinct_count(w.dense.development, "userId", "n_users")


@query
def genre_membership_counts(w: Workbench) -> DataFrame:
    return explore.word_counts(w.dense.development, "genres", GENRE_WORDS)


@query
def ratings_per_title(w: Workbench) -> DataFrame:
    return explore.ratings_per_title(w.dense.development)


@query
def most_rated_title(w: Workbench) -> DataFrame:
    return explore.most_rated_title(w.dense.development)


@query
def top5_ratings(w: Workbench) -> DataFrame:
    return explore.top_ratings(w.dense.development, 5)


@query
def eda_rating_distribution(w: Workbench) -> DataFrame:
    return explore.rating_distribution(w.dense.development)


@query
def eda_rating_moments(w: Workbench) -> DataFrame:
    return _tidy(explore.rating_moments(w.dense.development))


@query
def eda_movie_popularity(w: Workbench) -> DataFrame:
    return _tidy(explore.support(w.dense.development, "movieId"))


@query
def eda_popularity_correlation(w: Workbench) -> DataFrame:
    return _tidy(explore.popularity_correlation(w.dense.development))


@query
def eda_user_patterns(w: Workbench) -> DataFrame:
    return _tidy(explore.support(w.dense.development, "userId"))


@query
def eda_genre_ratings(w: Workbench) -> DataFrame:
    return _tidy(explore.support(w.dense.development, "genres"))


@query
def eda_extremes_by_support(w: Workbench) -> DataFrame:
    return _tidy(explore.extremes_by_support(w.sparse_repaired.development))


# ---- Genre-specific user effects and recommendations


@query
def fit_user_genre(w: Workbench) -> DataFrame:
    return _effects(w.ladder.with_user_genre, USER_GENRE)


@query
def rmse_user_genre(w: Workbench) -> DataFrame:
    return _rmse(w.dense.validation, w.ladder.with_user_genre)


@query
def recommend_topn(w: Workbench) -> DataFrame:
    seen = w.dense.development.select("userId", "movieId", "genres")
    return _tidy(recommend(seen, w.ladder.final, 5), digits=7)


@query
def recommend_user_genre(w: Workbench) -> DataFrame:
    seen = w.dense.development.select("userId", "movieId", "genres")
    return _tidy(recommend(seen, w.ladder.with_user_genre, 5), digits=7)


# ---- Time


@query
def activity_features(w: Workbench) -> DataFrame:
    ratings = w.enriched.select("userId", "movieId", "genres", "timestamp", "rating")
    found = point_in_time(ratings, (MOVIE_ACTIVITY, USER_ACTIVITY, GENRE_ACTIVITY))
    seconds = [c for c in found.columns if c.endswith("_idle")]
    return _tidy(found.withColumns({c: F.col(c).cast("double") for c in seconds}))


@query
def movie_bins_plain(w: Workbench) -> DataFrame:
    return _tidy(MovieBins.fit(w.dense.train, w.ladder.final, BIN_WIDTH, 0.0).effects)


@query
def movie_bins_smooth(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.movie_bins.effects)


@query
def user_drift(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.user_drift.table.frame)


@query
def richer_models(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.richer())


# ---- Latent factors


@query
def movie_factors(w: Workbench) -> DataFrame:
    parts = [F.get("_q", F.lit(k)).alias(f"q{k}") for k in range(w.ladder.factors.rank)]
    return _tidy(w.ladder.factors.movies.frame.select("movieId", *parts))


@query
def user_factors(w: Workbench) -> DataFrame:
    parts = [F.get("_p", F.lit(k)).alias(f"p{k}") for k in range(w.ladder.factors.rank)]
    return _tidy(w.ladder.factors.users.frame.select("userId", *parts))


@query
def recommend_factors(w: Workbench) -> DataFrame:
    seen = w.dense.development.select("userId", "movieId", "genres")
    found = recommend_by_factors(seen, w.ladder.factors, 5)
    return _tidy(found.drop("blocks"), digits=7)


# ---- Genre words and movies with few ratings


@query
def genre_word_weights(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.genre_words.weights)


@query
def movie_prior(w: Workbench) -> DataFrame:
    return _tidy(w.ladder.prior.movies.frame)


@query
def cold_start_errors(w: Workbench) -> DataFrame:
    prior = MoviePrior.fit(w.sparse.train, WORDS_LAMBDA)
    plain = effects.fit_effects(w.sparse.train, [MOVIE]).predict(w.sparse.validation)
    rows = plain.withColumnRenamed("pred", "plain").drop("b_i")
    return _tidy(errors_by_support(prior.predict(rows), 5))


# ---- Evaluation in time order, and blends


@query
def time_ordered_errors(w: Workbench) -> DataFrame:
    origins = time_origins(w.enriched, [0.5, 0.7, 0.9])
    return _tidy(backtest(w.enriched, origins, FIXED_LAMBDA))


BLENDED = {"movie": [MOVIE], "user": [USER]}


def _out_of_fold(w: Workbench) -> DataFrame:
    rows = w.dense.development.select("row_key", "userId", "movieId", "rating")
    return out_of_fold(rows, BLENDED, 3, FIXED_LAMBDA, ["row_key"])


@query
def out_of_fold_scores(w: Workbench) -> DataFrame:
    return _tidy(_out_of_fold(w).select("row_key", "fold", "mu", *BLENDED))


@query
def blend(w: Workbench) -> DataFrame:
    scored = _out_of_fold(w)
    weights = blend_weights(scored, list(BLENDED))
    lines = w.spark.createDataFrame([(f"weight of {c}", v) for c, v in weights.items()], "name string, value double")
    error = diagnostics.rmse_of(blended(scored, weights)).select(F.lit("rmse").alias("name"), F.col("rmse").alias("value"))
    return _tidy(lines.unionByName(error))


@query
def similar_titles(w: Workbench) -> DataFrame:
    return _tidy(most_similar_titles(w.movies, 10))
