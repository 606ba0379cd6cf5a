"""The whole analysis from two text files to the tables of the report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from starfit.functions import lambda_grid
from starfit.operators import diagnostics, explore
from starfit.operators.effects import GENRE
from starfit.operators.partition import ThreeWay, enrich, partition_three_way
from starfit.plans.ladder import Ladder
from starfit.sources.delimited import MOVIE_FIELDS, RATING_FIELDS, SEPARATOR, read_delimited
from starfit.sources.staging import stage

# The genres counted and the ratings counted in the exploration.
GENRE_WORDS = ("Drama", "Comedy", "Thriller", "Romance")
COUNTED_RATINGS = (0, 3)


@dataclass(frozen=True)
class Report:
    """Lazily computed tables over one partition of enriched ratings, and the final model."""

    parts: ThreeWay
    rejects: DataFrame
    grid: tuple[float, ...]
    genre_words: Sequence[str] = GENRE_WORDS

    @cached_property
    def ladder(self) -> Ladder:
        return Ladder(self.parts.train, self.parts.validation, self.grid, self.parts.holdout)

    def tables(self) -> dict[str, DataFrame]:
        """Every table of the report by name."""
        known = self.parts.development
        ladder = self.ladder
        return {
            "profile": explore.profile(known, ["userId", "movieId", "timestamp"]),
            "count_rating_eq": explore.count_equal(known, "rating", COUNTED_RATINGS),
            "distinct_movies": explore.distinct_count(known, "movieId", "n_movies"),
            "distinct_users": explore.distinct_count(known, "userId", "n_users"),
            "genre_membership_counts": explore.word_counts(known, "genres", self.genre_words),
            "most_rated_title": explore.most_rated_title(known),
            "top5_ratings": explore.top_ratings(known, 5),
            "lambda_curve_2level": ladder.curve(2),
            "lambda_curve_3level": ladder.curve(3),
            "genre_effect_ranking": diagnostics.effect_ranking(ladder.final, GENRE),
            "box_genre_effects": diagnostics.effect_boxes(ladder.final, GENRE),
            "model_comparison": ladder.comparison,
            "improvement_over_baseline": ladder.improvements(),
            "run_metrics": ladder.metrics(),
            "box_pred_by_rating": diagnostics.box_by_rating(ladder.scored_holdout),
            "bias_by_rating": diagnostics.bias_by_rating(ladder.scored_holdout),
            "pred_vs_actual_hist": diagnostics.histogram(ladder.scored_holdout),
            "scored_holdout": ladder.scored_holdout,
            "rejected_lines": self.rejects,
        }


def report(
    spark: SparkSession,
    ratings_path: str,
    movies_path: str,
    separator: str = SEPARATOR,
    grid: Sequence[float] | None = None,
) -> Report:
    """Read, enrich and partition; the text is parsed once."""
    ratings = read_delimited(spark, ratings_path, RATING_FIELDS, separator)
    movies = read_delimited(spark, movies_path, MOVIE_FIELDS, separator)
    enriched = stage(enrich(ratings.good, movies.good), "enriched")
    key_columns = [name for name, _ in RATING_FIELDS]
    return Report(
        partition_three_way(enriched, key_columns),
        ratings.rejects.unionByName(movies.rejects),
        tuple(grid or lambda_grid()),
    )
