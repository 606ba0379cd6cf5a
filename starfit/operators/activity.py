"""What was known of a user and a movie when a rating was given.

All features count strictly earlier ratings only, so ratings of the same second know nothing of
each other and none leaks its own value. A rating without a timestamp counts for nobody and has no
features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.operators.keyed import SMALL_BYTES, KeyedTable, attach
from starfit.operators.prefix import sums_before
from starfit.sources.staging import stage

TIME = "timestamp"
RATING = "rating"
#: Key and the features' prefix.
MOVIE_ACTIVITY = ("movieId", "movie")
USER_ACTIVITY = ("userId", "user")
GENRE_ACTIVITY = ("genres", "genre")


def history(ratings: DataFrame, key: str, prefix: str) -> DataFrame:
    """Per key and time, how many ratings came before, their sum, and the time of the last.

    Ratings of one key and second are summed up before the shuffle.
    """
    moments = ratings.where(F.col(TIME).isNotNull()).groupBy(key, TIME)
    moments = stage(moments.agg(F.count("*").alias("n"), F.sum(RATING).alias("s")), f"{prefix}-moments")
    return sums_before(moments, [key], TIME, ["n", "s"]).select(
        key,
        TIME,
        F.col("n_before").alias(f"{prefix}_ratings"),
        F.col("s_before").alias(f"_{prefix}_sum"),  # takes less room in a shuffle than the mean
        (F.col(TIME) - F.col(f"{TIME}_before")).alias(f"{prefix}_idle"),
    )


def point_in_time(
    ratings: DataFrame,
    of: tuple[tuple[str, str], ...] = (MOVIE_ACTIVITY, USER_ACTIVITY),
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """``ratings`` with ``<prefix>_ratings``, ``<prefix>_mean`` and ``<prefix>_idle`` of each key.

    Popularity or activity so far, the mean rating so far (null without one), and seconds since
    the rating before (null without one).
    """
    tables = [KeyedTable.write(history(ratings, key, prefix), [key, TIME], f"{prefix}-history") for key, prefix in of]
    found = attach(ratings, tables, small_bytes)
    features = []
    for _, prefix in of:
        n, total = F.col(f"{prefix}_ratings"), F.col(f"_{prefix}_sum")
        features += [n, F.when(n > 0, total / n).alias(f"{prefix}_mean"), F.col(f"{prefix}_idle")]
    return found.select(*ratings.columns, *features)
