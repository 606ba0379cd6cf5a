import math

import pytest
from pyspark.sql import functions as F

from starfit.functions import lambda_grid, support_band
from starfit.operators import diagnostics, explore, quantiles
from starfit.operators.effects import GENRE, MOVIE, USER, USER_GENRE, fit_effects
from starfit.operators.recommend import recommend


@pytest.fixture(scope="module")
def model(mini_train):
    return fit_effects(mini_train, [MOVIE, USER, GENRE], 1.0)


def test_grid():
    assert lambda_grid()[:3] == [0.0, 0.25, 0.5] and lambda_grid()[-1] == 10.0 and len(lambda_grid()) == 41
    with pytest.raises(ValueError):
        lambda_grid(step=0)


def test_exploration(mini_train):
    assert [tuple(r) for r in explore.count_equal(mini_train, "rating", [0, 3]).collect()] == [(0.0, 0), (3.0, 1)]
    assert explore.distinct_count(mini_train, "genres", "n").first().n == 3  # missing is one of them
    words = explore.word_counts(mini_train, "genres", ["Drama", "Comedy", "War"]).first().asDict()
    assert words == {"Drama": 5, "Comedy": 2, "War": 0}
    titled = mini_train.withColumn("title", F.when(F.col("movieId") == 10, "A").otherwise("B"))
    assert tuple(explore.most_rated_title(titled).first()) == ("A", 3)
    assert [r["count"] for r in explore.top_ratings(mini_train, 2).collect()] == [1, 1]
    moments = explore.rating_moments(mini_train).first()
    assert moments.mean_rating == pytest.approx(20 / 6)


def test_profile(mini_train):
    rows = explore.profile(mini_train, ["userId", "movieId"], 2).orderBy("ordinal").collect()
    assert [r.type for r in rows] == ["int", "int", "double", "string"]
    assert [r.first_values for r in rows] == ["1, 1", "10, 20", "5.0, 3.0", "Drama, Comedy|Drama"]
    assert {(r.n_rows, r.n_columns) for r in rows} == {(6, 4)}


def test_support_bands(spark):
    rows = spark.createDataFrame([(n,) for n in (1, 2, 4, 5, 9, 10, 99, 100, 12345, 7 * 10**12)], "n long")
    bands = [r.b for r in rows.select(support_band(F.col("n")).alias("b")).collect()]
    assert bands == [1, 2, 2, 5, 5, 10, 50, 100, 10000, 5 * 10**12]


def test_bias_and_histogram(mini_validation, model):
    scored = model.predict(mini_validation)
    assert sum(r.n for r in diagnostics.histogram(scored).collect()) == 4
    bias = {r.rating: r.bias for r in diagnostics.bias_by_rating(scored).collect()}
    assert bias[2.5] == pytest.approx(2.872685 - 2.5, abs=1e-6)
    worst = diagnostics.extreme_errors(scored, 1, ["userId"]).first()
    best = diagnostics.extreme_errors(scored, 1, ["userId"], worst=False).first()
    assert worst.movieId == 20 and best.movieId == 40


def test_gain_over_a_perfect_baseline(spark):
    saved, percent = diagnostics.gain_over(F.lit(0.0), F.lit(0.5))
    row = spark.range(1).select(saved.alias("s"), percent.alias("p")).first()
    assert row.s == -0.5 and row.p is None


def brute_force(rows, effects, mu, n):
    b_i, b_u, b_g = effects
    movies = {(m, g) for _, m, g in rows}
    seen = {}
    for u, m, _ in rows:
        seen.setdefault(u, set()).add(m)
    out = {}
    for u, mine in seen.items():
        scored = [(-round(b_i[m] + b_g[g], 9), m) for m, g in movies if m not in mine]
        for rank, (score, m) in enumerate(sorted(scored)[:n], 1):
            out[u, rank] = (m, round(mu + b_u[u] - score, 6))
    return out


@pytest.mark.parametrize("first_block, max_block", [(None, 500_000), (1, 500_000), (3, 16)])
def test_recommendations_equal_brute_force(spark, first_block, max_block):
    # User 0 has seen nearly everything, user 1 nearly nothing, user 2 everything.
    pairs = [(0, m) for m in range(58)] + [(1, 59)] + [(2, m) for m in range(60)]
    pairs += [(u, m) for u in range(3, 30) for m in range(60) if (u * 7 + m * 11) % 5 == 0]
    rows = [(u, m, ((u * 13 + m * 29) % 10 + 1) / 2, f"g{m % 4}") for u, m in pairs]
    seen = spark.createDataFrame(rows, "userId int, movieId int, rating double, genres string")
    model = fit_effects(seen, [MOVIE, USER, GENRE], 2.0)
    effects = [
        {r[level.keys[0]]: r[level.effect] for r in model.effects(level).collect()}
        for level in (MOVIE, USER, GENRE)
    ]
    expected = brute_force([(u, m, g) for u, m, _, g in rows], effects, model.mu, 4)
    found = {
        (r.userId, r["rank"]): (r.movieId, round(r.pred, 6))
        for r in recommend(seen, model, 4, first_block, max_block).collect()
    }
    assert found == expected
    assert (2, 1) not in found and (0, 2) in found and (0, 3) not in found


def test_histogram_bands_hold_their_predictions(mini_validation, model):
    scored = model.predict(mini_validation)
    for r in scored.select("rating", "pred").collect():
        low = math.floor(r.pred / 0.25) * 0.25
        assert diagnostics.histogram(scored).filter(
            (F.col("rating") == r.rating) & (F.col("pred_from") == low)
        ).count() == 1


def test_levels_of_user_and_movie_are_refused(mini_train, model):
    with pytest.raises(ValueError, match="userId, genres"):
        recommend(mini_train, model.plus(mini_train, USER_GENRE, 1.0), 2)


def test_a_movie_with_two_genres_is_offered_once(spark):
    rows = [(1, 10, 5.0, "b"), (2, 10, 5.0, "a"), (1, 20, 1.0, "c"), (3, 20, 2.0, "c"), (3, 30, 3.0, "c"), (2, 30, 3.0, "c")]
    seen = spark.createDataFrame(rows, "userId int, movieId int, rating double, genres string")
    own = fit_effects(seen, [MOVIE, USER, GENRE], 1.0)
    found = {(r.userId, r["rank"]): r for r in recommend(seen, own, 3, digits=1).collect()}
    assert found[3, 1].movieId == 10 and (3, 2) not in found
    asked = spark.createDataFrame([(3, 10, "a")], "userId int, movieId int, genres string")
    assert found[3, 1].pred == pytest.approx(own.predict(asked).first().pred, abs=1e-12)


@pytest.mark.parametrize("small_group", [200_000, 2])
def test_boxes_on_both_ways(spark, small_group):
    rows = spark.createDataFrame([(k % 2, float(k * k % 97)) for k in range(60)], "g int, v double")
    found = {tuple(r) for r in quantiles.box_statistics(rows, ["g"], "v", small_group).collect()}
    assert found == {tuple(r) for r in quantiles.box_statistics(rows, ["g"], "v").collect()}
