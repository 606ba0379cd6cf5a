"""Movies with the most similar titles, without comparing all pairs.

A title is the set of its words, weighted by rarity and brought to length one; similarity is the
product of two titles. Each word has a list of the titles that hold it, the heaviest first, cut
into blocks that grow. A title opens the blocks of its words round by round and scores whatever it
meets. A title not met yet weighs no more in a word than the next block's first, which bounds its
similarity; a title has done once its k-th best is above that bound, or its lists are at their ends.

Titles of the same words are one set, named by its smallest movie id, and only sets are compared; a
movie's list is its set's, without itself. So copies of a title cost no more than one.

A block is one row, looked up by word and number, so a word that very many titles share is a hot
key of a lookup (``keyed``) and never a join of its titles with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfit.functions import or_zero
from starfit.operators.keyed import SMALL_BYTES, KeyedTable, attach
from starfit.operators.prefix import placed
from starfit.sources.staging import stage

#: Titles in a word's first block; every next one holds eight times as many, up to the largest.
FIRST_BLOCK, GROWTH, LARGEST_BLOCK = 64, 8, 32_768
#: Sums of the same products in another order may differ by so much.
_SLACK = 1e-9


def block_ends(first: int, largest: int, n: int) -> list[int]:
    """Last places of the blocks of a list of ``n``."""
    ends, size = [min(first, n)], first
    while ends[-1] < n:
        size = min(size * GROWTH, largest)
        ends.append(min(n, ends[-1] + size))
    return ends


def word_sets(movies: DataFrame) -> DataFrame:
    """movieId and the sorted distinct words, as one text, of every title that has words. Written."""
    words = F.filter(F.array_distinct(F.split(F.lower(F.trim("title")), r"\s+")), lambda w: w != "")
    rows = movies.filter("title IS NOT NULL").groupBy("movieId").agg(F.min("title").alias("title"))
    rows = rows.select("movieId", F.array_join(F.array_sort(words), " ").alias("words"))
    return stage(rows.filter("words <> ''"), "word-sets")


def title_vectors(sets: DataFrame) -> DataFrame:
    """movieId, word and weight of every word of every set (movieId, words, n titles). Written.

    Weights are ln(1 + titles / titles with the word), divided by the title's length.
    """
    rows = stage(sets.select("movieId", "n", F.explode(F.split("words", " ")).alias("word")), "title-words")
    n = sets.agg(F.sum("n")).first()[0] or 0
    rarity = rows.groupBy("word").agg(F.log(1 + F.lit(float(n)) / F.sum("n")).alias("_idf"))
    rows = rows.filter("movieId IS NOT NULL").drop("n")
    weighted = stage(attach(rows, [KeyedTable.write(rarity, ["word"], "word-rarity")]), "title-weights")
    length = weighted.groupBy("movieId").agg(F.sqrt(F.sum(F.col("_idf") * F.col("_idf"))).alias("_length"))
    sized = attach(weighted, [KeyedTable.write(length, ["movieId"], "title-lengths")])
    return stage(sized.select("movieId", "word", (F.col("_idf") / F.col("_length")).alias("weight")), "title-vectors")


def _product(a: str, b: str) -> Column:
    """The product of two word-to-weight maps."""
    return F.aggregate(F.map_entries(a), F.lit(0.0), lambda x, e: x + e["value"] * or_zero(F.col(b)[e["key"]]))


def similar_titles(
    movies: DataFrame,
    k: int,
    first_block: int = FIRST_BLOCK,
    largest_block: int = LARGEST_BLOCK,
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """movieId, rank, similar (another movie) and similarity above 0 of each movie's k most similar.

    Similarities count to 9 places; equal ones go by the smaller movie id.
    """
    titles = word_sets(movies)
    sets = titles.groupBy("words").agg(F.min("movieId").alias("movieId"), F.count("*").alias("n"))
    sets = stage(sets, "distinct-sets")
    # The movies of all sets come by similarity and then by id. Of one set only its first k + 1 can be
    # among a movie's k best and the movie itself, and so can only the sets with the k + 1 best firsts.
    near = _nearest_sets(title_vectors(sets), k + 1, first_block, largest_block, small_bytes)
    here = sets.filter("movieId IS NOT NULL").select("words", F.col("movieId").alias("_set"))
    same = here.select(F.col("_set").alias("movieId"), F.col("_set").alias("similar"), F.lit(1.0).alias("similarity"))
    members = Window.partitionBy("words").orderBy("movieId")
    firsts = titles.filter("movieId IS NOT NULL").withColumn("_i", F.row_number().over(members)).filter(F.col("_i") <= k + 1)
    firsts = firsts.groupBy("words").agg(F.collect_list("movieId").alias("_members"))
    named = KeyedTable.write(here, ["words"], "set-names")
    firsts = attach(firsts, [named], small_bytes).select(F.col("_set").alias("similar"), "_members")
    offered = attach(
        near.select("movieId", "similar", "similarity").unionByName(same),
        [KeyedTable.write(firsts, ["similar"], "first-members")],
        small_bytes,
    )
    offered = offered.select(F.col("movieId").alias("_set"), F.explode("_members").alias("similar"), "similarity")
    best = Window.partitionBy("_set").orderBy(F.desc("similarity"), F.asc("similar"))
    listed = offered.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k + 1)
    listed = listed.groupBy("_set").agg(F.array_sort(F.collect_list(F.struct("rank", "similar", "similarity"))).alias("_best"))
    listed = KeyedTable.write(listed, ["_set"], "best-of-sets", array_items=4 * (k + 1))
    asking = titles.filter("movieId IS NOT NULL")
    told = attach(attach(asking, [named], small_bytes), [listed], small_bytes)
    # A movie skips itself; all of a set's movies otherwise have the same list.
    others = F.slice(F.filter("_best", lambda x: x["similar"] != F.col("movieId")), 1, k)
    return told.select("movieId", F.posexplode(others).alias("_i", "_x")).select(
        "movieId",
        (F.col("_i") + 1).cast("bigint").alias("rank"),
        F.col("_x.similar").alias("similar"),
        F.col("_x.similarity").alias("similarity"),
    )


def _nearest_sets(vectors: DataFrame, k: int, first_block: int, largest_block: int, small_bytes: int) -> DataFrame:
    """movieId, similar and similarity above 0 of each set's k nearest other ones, named by movies."""
    lists = placed(vectors.withColumn("_down", -F.col("weight")), ["word"], "_down", ["movieId"], "_place").drop("_down")
    lists = stage(lists, "word-lists")
    longest = lists.agg(F.max("_place")).first()[0] or 0
    ends = block_ends(first_block, largest_block, longest)
    block = sum((F.when(F.col("_place") > e, 1).otherwise(0) for e in ends[:-1]), F.lit(0))
    # A row holds at most ``largest_block`` titles.
    blocks = stage(
        lists.groupBy("word", block.alias("_block")).agg(
            F.collect_list("movieId").alias("_members"), F.max("weight").alias("_most")
        ),
        "word-blocks",
    )
    maps = vectors.groupBy("movieId").agg(F.map_from_entries(F.collect_list(F.struct("word", "weight"))).alias("_map"))
    maps = stage(maps, "title-maps")
    other = KeyedTable.measure(maps.select(F.col("movieId").alias("similar"), F.map_keys("_map").alias("_w")), ["similar"])
    theirs = KeyedTable(
        maps.select(F.col("movieId").alias("similar"), F.col("_map").alias("_theirs")), ("similar",), other.n_rows, 4 * other.n_bytes
    )
    mine = KeyedTable(maps, ("movieId",), other.n_rows, 4 * other.n_bytes)
    best = Window.partitionBy("movieId").orderBy(F.desc("similarity"), F.asc("similar"))
    open_ = maps.select("movieId")
    found: DataFrame | None = None
    done: list[DataFrame] = []
    for number in range(len(ends)):
        asking = attach(vectors, [KeyedTable.write(open_.withColumn("_asks", F.lit(True)), ["movieId"], "asking")], small_bytes)
        asking = asking.filter("_asks").select("movieId", "word", "weight", F.lit(number).alias("_block"))
        here = KeyedTable.write(blocks.filter(F.col("_block") == number).select("word", "_block", "_members"), ["word", "_block"], "blocks-here")
        met = attach(asking, [here], small_bytes).filter("_members IS NOT NULL")
        met = met.select("movieId", F.explode("_members").alias("similar")).filter("movieId <> similar").distinct()
        scored = attach(met, [mine, theirs], small_bytes)
        scored = scored.select("movieId", "similar", F.round(_product("_map", "_theirs"), 9).alias("similarity"))
        if found is not None:
            scored = scored.unionByName(found.select("movieId", "similar", "similarity")).distinct()
        ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        found = stage(ranked, "most-similar")
        if number + 1 == len(ends):
            done.append(found)
            break
        # What a title that is still to be met can reach.
        coming = blocks.filter(F.col("_block") == number + 1).select("word", "_most")
        ahead = attach(asking.drop("_block"), [KeyedTable.write(coming, ["word"], "blocks-ahead")], small_bytes)
        bound = ahead.groupBy("movieId").agg(F.sum(F.col("weight") * or_zero(F.col("_most"))).alias("_bound"))
        reached = found.filter(F.col("rank") == k).select("movieId", F.col("similarity").alias("_reached"))
        state = attach(bound, [KeyedTable.write(reached, ["movieId"], "reached")], small_bytes)
        state = state.withColumn("_open", (F.col("_bound") > 0) & ~(or_zero(F.col("_reached")) > F.col("_bound") + _SLACK))
        state = KeyedTable.write(state.select("movieId", "_open"), ["movieId"], "state")
        told = stage(attach(found, [state], small_bytes), "told")
        done.append(told.filter("NOT _open").drop("_open"))
        found = told.filter("_open").drop("_open")
        open_ = state.frame.filter("_open").select("movieId")
        if open_.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.filter("similarity > 0").select("movieId", "similar", "similarity")
