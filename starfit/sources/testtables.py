"""Ratings and movies seen in the given order tables.

A line item is a rating: its order's customer rates its part with half a star per five
items ordered. ``row_key`` is unique on every row and feeds the split's hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BARE_BRAND = "Brand#13"
BARE_TYPE = "SMALL"
ENRICHED_COLUMNS = ("userId", "movieId", "rating", "timestamp", "title", "genres")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, movieId, rating, timestamp, and line_number and row_key of the source row."""
    items = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    key = F.concat_ws(
        "|",
        *[
            c.cast("string")
            for c in (
                F.col("l_orderkey"),
                F.col("l_linenumber"),
                F.col("l_partkey"),
                F.col("l_suppkey"),
                F.col("_cents"),
            )
        ],
    )
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    placed = F.col("o_orderdate").cast("timestamp_ntz")
    # Whole cents and few different ratings are shipped to the orders, not prices and quantities.
    items = items.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        cents.alias("_cents"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("rating"),
    )
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        "rating",
        F.timestamp_diff("SECOND", epoch, placed).alias("timestamp"),
        F.col("l_linenumber").alias("line_number"),
        key.alias("row_key"),
    )


def rated_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movieId of every line item, with an order or without."""
    return _table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("movieId"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movieId, title, genres of every part. One brand's small parts have neither title nor
    genres, so that missing values are in play."""
    bare = (F.col("p_brand") == BARE_BRAND) & (F.col("p_type") == BARE_TYPE)
    genres = F.concat_ws("|", "p_type", F.split_part("p_name", F.lit(" "), F.lit(2)))
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movieId"),
        F.when(~bare, F.col("p_name")).alias("title"),
        F.when(~bare, genres).alias("genres"),
    )


def sparse_ids(enriched: DataFrame) -> DataFrame:
    """Finer movie ids, so that some movies have very few ratings."""
    return enriched.withColumn("movieId", F.col("movieId") * 10 + F.col("line_number"))
