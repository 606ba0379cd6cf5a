import random

import pytest
from pyspark.sql import functions as F

from starfit.operators.activity import point_in_time
from starfit.operators.prefix import cut_points, placed, sums_before


def draw_rows(seed=3, n=900):
    """A hot key, tied and missing times, missing keys."""
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        movie = draw.choice([1, 1, 1, 2, 3, None, draw.randint(4, 60)])
        when = draw.choice([None, *range(0, 4000, 7)]) if k % 3 else draw.randint(0, 20)
        rows.append((draw.choice([7, 7, draw.randint(8, 40)]), movie, draw.randint(1, 10) / 2, when))
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp bigint").repartition(5)


@pytest.mark.parametrize("small_bytes", [64 << 20, 0], ids=["broadcast", "shuffled"])
def test_features_equal_counting_all_earlier_rows(spark, small_bytes, no_auto_broadcast):
    rows = draw_rows()
    found = point_in_time(frame_of(spark, rows), small_bytes=small_bytes).collect()
    assert sorted(map(str, [r[:4] for r in found])) == sorted(map(str, rows))
    for r in found:
        for key, prefix in ((1, "movie"), (0, "user")):
            got = r[f"{prefix}_ratings"], r[f"{prefix}_mean"], r[f"{prefix}_idle"]
            if r[3] is None:
                assert got == (None, None, None)
                continue
            earlier = [x for x in rows if x[key] == r[key] and x[3] is not None and x[3] < r[3]]
            n = len(earlier)
            mean = sum(x[2] for x in earlier) / n if n else None
            assert got == (n, pytest.approx(mean) if n else None, r[3] - max(x[3] for x in earlier) if n else None)


def test_hot_keys_are_cut_into_cells(spark):
    frame = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"), F.col("id").alias("t"), F.lit(1).alias("n")
    )
    (hot,) = cut_points(frame, ["k"], "t").collect()
    assert hot.k == -1 and len(hot["_cuts"]) >= 2 and sorted(hot["_cuts"]) == hot["_cuts"]
    rows = sums_before(frame, ["k"], "t", ["n"]).where("k = -1").orderBy("t").collect()
    assert [r.n_before for r in rows] == list(range(len(rows)))
    assert [r.t_before for r in rows[1:]] == [r.t for r in rows[:-1]] and rows[0].t_before is None


def test_places_with_ties_and_an_empty_table(spark):
    rows = [("a", 1.0, 5), ("a", 1.0, 2), ("a", 0.5, 9), ("b", 2.0, 1), (None, 1.0, 1), ("a", None, 3)]
    frame = spark.createDataFrame(rows, "k string, x double, id int")
    got = {(r.k, r.id): r.place for r in placed(frame, ["k"], "x", ["id"], "place").collect()}
    assert got == {("a", 3): 1, ("a", 9): 2, ("a", 2): 3, ("a", 5): 4, ("b", 1): 1, (None, 1): 1}
    assert placed(frame.where("false"), ["k"], "x", ["id"], "place").count() == 0
