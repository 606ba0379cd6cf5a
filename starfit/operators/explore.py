"""Questions about a ratings table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.functions import support_band


def profile(frame: DataFrame, order_by: Sequence[str], n_first: int = 5) -> DataFrame:
    """One row per column: position, name, type, table size and the first values.

    "First" is by ``order_by``, since a distributed table has no row order of its own.
    """
    first = frame.orderBy(*order_by).limit(n_first)
    listed = first.agg(
        *[
            F.sort_array(
                F.collect_list(F.struct(*order_by, F.col(c).cast("string").alias("_text")))
            ).alias(f"_{i}")
            for i, c in enumerate(frame.columns)
        ]
    )
    rows = [
        F.struct(
            F.lit(i + 1).cast("bigint").alias("ordinal"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.array_join(F.col(f"_{i}")["_text"], ", ", "NA").alias("first_values"),
        )
        for i, field in enumerate(frame.schema.fields)
    ]
    return listed.select(F.inline(F.array(*rows))).withColumns(
        {
            "n_rows": frame.agg(F.count("*")).scalar(),
            "n_columns": F.lit(len(frame.columns)).cast("bigint"),
        }
    )


def count_equal(frame: DataFrame, column: str, values: Sequence[float]) -> DataFrame:
    """How many rows hold each value, in one pass; absent values count 0."""
    counts = frame.agg(
        *[F.count_if(F.col(column) == v).alias(f"n{i}") for i, v in enumerate(values)]
    )
    pairs = [
        F.struct(F.lit(float(v)).alias("value"), F.col(f"n{i}").alias("n"))
        for i, v in enumerate(values)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def distinct_count(frame: DataFrame, key: str, name: str) -> DataFrame:
    """Number of distinct keys; a missing key counts as one more."""
    return frame.select(key).distinct().agg(F.count("*").alias(name))


def word_counts(frame: DataFrame, column: str, words: Sequence[str]) -> DataFrame:
    """Rows whose text holds each word, one result column per word. A row may count often."""
    return frame.agg(*[F.count_if(F.col(column).rlike(w)).alias(w) for w in words])


def ratings_per_title(frame: DataFrame) -> DataFrame:
    """By title, so movies that share a title count together."""
    return frame.groupBy("title").agg(F.count("*").alias("number_of_ratings"))


def most_rated_title(frame: DataFrame) -> DataFrame:
    return ratings_per_title(frame).orderBy(F.desc("number_of_ratings"), "title").limit(1)


def top_ratings(frame: DataFrame, k: int = 5) -> DataFrame:
    counts = frame.groupBy("rating").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "rating").limit(k)


def rating_distribution(frame: DataFrame) -> DataFrame:
    return frame.groupBy("rating").agg(F.count("*").alias("n"))


def rating_moments(frame: DataFrame) -> DataFrame:
    return frame.agg(
        F.count("*").alias("n"),
        F.avg("rating").alias("mean_rating"),
        F.var_samp("rating").alias("variance"),
    )


def support(frame: DataFrame, key: str) -> DataFrame:
    """Count, mean and spread of the ratings per key."""
    return frame.groupBy(key).agg(
        F.count("*").alias("n"),
        F.avg("rating").alias("mean_rating"),
        F.stddev_samp("rating").alias("sd_rating"),
    )


def popularity_correlation(frame: DataFrame) -> DataFrame:
    """Over movies: number of ratings against mean rating."""
    movies = support(frame, "movieId")
    return movies.agg(F.count("*").alias("n_movies"), F.corr("n", "mean_rating").alias("corr"))


def extremes_by_support(frame: DataFrame) -> DataFrame:
    """Spread of the movies' mean ratings by how many ratings they have."""
    movies = support(frame, "movieId").withColumn("at_least", support_band(F.col("n")))
    return movies.groupBy("at_least").agg(
        F.count("*").alias("n_movies"),
        F.min("mean_rating").alias("min_mean"),
        F.max("mean_rating").alias("max_mean"),
        F.avg("mean_rating").alias("avg_mean"),
        F.stddev_samp("mean_rating").alias("sd_mean"),
    )
