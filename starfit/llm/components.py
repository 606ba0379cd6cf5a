"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.tables import staged


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the smallest id reached.

    Rounds of large-star and small-star: every id hands its larger neighbours, then its smaller
    ones, to the smallest id it knows, until each id is linked to its component's smallest alone.
    The number of rounds grows with the logarithm of the longest path. The smallest neighbour is
    an aggregate, so ids with very many links are summed up before the shuffle, and the joins are
    plain equi-joins that adaptive execution can split. Links of an id with itself are ignored;
    their ids are not returned.
    """
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large star: larger neighbours join the smallest id known.
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = staged(large, "large-star")
        # Small star: an id and its smaller neighbours join the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        nxt = (
            small.select("a", F.col("m").alias("b"))
            .unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        nxt = staged(nxt, "small-star")
        # Done when no id is linked to two, and no smallest id is linked on.
        again = nxt.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        chained = nxt.select("b").distinct().join(nxt.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        if not again and not chained:
            smallest = nxt.select(F.col("b").alias("id")).distinct()
            return nxt.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                smallest.select("id", F.col("id").alias("component"))
            )
        edges = nxt
