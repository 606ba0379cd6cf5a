import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starfit.functions import row_hash
from starfit.operators.keyed import HotKeys
from starfit.operators.partition import (
    enrich,
    known_to_rest,
    partition_three_way,
    repair_holdout,
)
from starfit.operators.split import (
    SAMPLED,
    STRATUM,
    find_cutoffs,
    strata_breaks,
    stratified_sample,
    stratum_of,
)
from starfit.plans.workbench import workbench

SIX = ["userId", "movieId", "rating", "timestamp", "title", "genres"]


def multiset(frame, columns=None):
    return Counter(tuple(r) for r in frame.select(*(columns or frame.columns)).collect())


@pytest.fixture(scope="module")
def bench(spark, sf_dir):
    return workbench(spark, sf_dir)


def test_known_counts(bench):
    sampled = bench.sparse_sample.filter(SAMPLED).count()
    assert (sampled, bench.sparse_repaired.holdout.count(), bench.sparse_repaired.removed.count()) == (602, 583, 19)
    assert bench.dense.holdout.count() == 602


def test_each_stratum_gives_its_exact_share(bench):
    for r in bench.sparse_sample.groupBy(STRATUM).agg(
        F.count("*").alias("n"), F.count_if(SAMPLED).alias("k")
    ).collect():
        assert r.k == math.ceil(r.n * 0.1)


def test_parts_add_up_to_the_input(bench):
    parts = bench.sparse
    whole = Counter()
    for part in (parts.train, parts.validation, parts.holdout):
        whole += multiset(part, ["row_key", "movieId"])
    assert whole == multiset(bench.sparse_sample, ["row_key", "movieId"])
    assert multiset(parts.development, SIX) == multiset(parts.train, SIX) + multiset(parts.validation, SIX)


def test_holdout_keys_are_known(bench):
    parts = bench.sparse
    for key in ("movieId", "userId"):
        unknown = parts.holdout.join(parts.development, key, "left_anti")
        assert unknown.count() == 0


def test_split_does_not_depend_on_partitions(bench):
    rows = bench.enriched.select("userId", "movieId", "rating", "row_key")
    chosen = [
        multiset(stratified_sample(rows.repartition(p), 0.1, "1", key_columns=["row_key"]).filter(SAMPLED))
        for p in (1, 7)
    ]
    assert chosen[0] == chosen[1]


@pytest.mark.parametrize("few_rows", [1_000_000, 10])
def test_cutoffs_equal_a_full_ranking(bench, few_rows):
    rows = bench.enriched
    breaks = strata_breaks(rows, "rating")
    hashed = rows.withColumn(STRATUM, stratum_of(F.col("rating"), breaks)).withColumn(
        "_hash", row_hash("1", ["row_key"])
    )
    found = {c.stratum: c for c in find_cutoffs(hashed, F.ceil(F.col("n") * 0.1), few_rows)}
    own = {}
    for r in hashed.select(STRATUM, "_hash").collect():
        own.setdefault(r[STRATUM], []).append(r["_hash"])
    assert set(found) == set(own)
    for s, hashes in own.items():
        k = math.ceil(len(hashes) * 0.1)
        assert found[s].last_hash == sorted(hashes)[k - 1]
        assert (found[s].n, found[s].quota) == (len(hashes), k)


def test_copies_of_one_row_are_split_exactly(spark):
    """A third of all rows and more are one and the same row."""
    copies = spark.range(3000).select(
        F.when(F.col("id") < 1800, 0).otherwise(F.col("id")).alias("userId"),
        F.when(F.col("id") < 1800, 3.0).otherwise((F.col("id") % 10 + 1) / 2).alias("rating"),
    )
    for share, seed in ((0.1, "a"), (0.5, "b"), (0.9, "c")):
        sampled = stratified_sample(copies, share, seed)
        counts = sampled.groupBy(STRATUM).agg(F.count("*").alias("n"), F.count_if(SAMPLED).alias("k"))
        for r in counts.collect():
            assert r.k == math.ceil(r.n * share)
        assert multiset(sampled, ["userId", "rating"]) == multiset(copies)
        again = stratified_sample(copies.repartition(9), share, seed)
        assert multiset(again.filter(SAMPLED)) == multiset(sampled.filter(SAMPLED))


def test_breaks_that_coincide(spark):
    low = spark.createDataFrame([(v,) for v in [1.0] * 6 + [2.0, 3.0]], "rating double")
    assert strata_breaks(low, "rating") == [1.25]
    same = spark.createDataFrame([(2.0,)] * 5, "rating double")
    assert strata_breaks(same, "rating") == []
    assert stratified_sample(same, 0.5, "1").filter(SAMPLED).count() == 3


def test_repair_on_a_hand_made_sample(spark):
    rows = [
        (1, 1, False), (1, 2, False), (2, 1, False), (None, 2, False),
        (1, 1, True),  # both keys known
        (1, 9, True),  # movie only in the sample
        (8, 1, True),  # user only in the sample
        (None, 1, True),  # the missing user occurs elsewhere
        (2, None, True),  # the missing movie does not
    ]
    frame = spark.createDataFrame(rows, "userId int, movieId int, sampled boolean").withColumn(STRATUM, F.lit(0))
    for small_bytes in (64 << 20, 0):
        fixed = repair_holdout(frame, small_bytes=small_bytes)
        assert multiset(fixed.holdout) == Counter([(1, 1), (None, 1)])
        assert multiset(fixed.removed) == Counter([(1, 9), (8, 1), (2, None)])
        assert fixed.development.count() == 7
        flags = known_to_rest(frame, ["movieId"], small_bytes)
        assert flags.filter("known_movieId").count() == 3


def test_second_split_spreads_the_returned_rows(bench):
    """With one seed for both splits all returned rows would become validation rows."""
    returned = bench.sparse_repaired.removed.select("row_key")
    in_train = bench.sparse.train.join(returned, "row_key", "left_semi").count()
    assert 0 < in_train


def test_enrich_keeps_every_rating(spark):
    ratings = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, None)], "userId int, movieId int")
    movies = spark.createDataFrame([(5, "A", "X|Y"), (7, "B", "Z"), (None, "N", "W")], "movieId int, title string, genres string")
    for small_bytes in (64 << 20, 0):
        out = enrich(ratings, movies, small_bytes)
        assert multiset(out) == Counter(
            [(1, 5, "A", "X|Y"), (2, 5, "A", "X|Y"), (3, 6, None, None), (4, None, "N", "W")]
        )
    with pytest.raises(ValueError):
        enrich(ratings, movies.union(movies))


def test_default_hash_covers_all_columns(spark):
    frame = spark.range(500).select(
        (F.col("id") % 50).alias("userId"), F.col("id").alias("movieId"), ((F.col("id") % 10 + 1) / 2).alias("rating")
    )
    parts = partition_three_way(frame)
    total = Counter()
    for part in (parts.train, parts.validation, parts.holdout):
        total += multiset(part, frame.columns)
    assert total == multiset(frame)


def test_given_hot_keys_spare_working_out_the_ratings(spark, no_auto_broadcast):
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    ids = spark.range(600).selectExpr("int(id % 7) AS movieId")
    ratings = ids.mapInArrow(seen, "movieId int")
    movies = spark.createDataFrame([(k, f"t{k}", "g") for k in range(5)], "movieId int, title string, genres string")
    out = enrich(ratings, movies, 0, HotKeys(ids))
    assert counted.value == 0
    assert out.filter("title IS NULL").count() == sum(k % 7 >= 5 for k in range(600))
