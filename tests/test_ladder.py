import random

import pytest
from pyspark.sql import functions as F

from starfit.operators import effects
from starfit.operators.diagnostics import rmse_of
from starfit.operators.effects import GENRE, MOVIE, USER, USER_GENRE, fit_effects, fit_grid
from starfit.operators.timed import DAY
from starfit.plans.ladder import Ladder


@pytest.fixture(scope="module")
def rated(spark):
    """Ratings with a hot movie, missing genres and times, and movies and users new to validation."""
    draw = random.Random(11)
    genres = {m: draw.choice(["A", "A|B", "B|C", None]) for m in range(40)}
    rows = []
    for k in range(900):
        m = draw.choice([1, draw.randrange(40)])
        time = None if k % 50 == 0 else draw.randrange(900) * DAY
        rows.append((draw.randrange(30), m, draw.randint(1, 10) / 2, time, genres[m]))
    schema = "userId int, movieId int, rating double, timestamp bigint, genres string"
    train = spark.createDataFrame([r for r in rows[:700] if r[0] < 28 and r[1] < 38], schema)
    return train, spark.createDataFrame(rows[700:], schema)


def ladder(rated):
    return Ladder(*rated, grid=(0.0, 2.0, 5.0))


def test_richer_models_look_movies_up_once_for_training_and_once_for_validation(rated, monkeypatch):
    shared = ladder(rated)
    assert shared.final is not None
    lookups = []
    attach = effects.attach
    monkeypatch.setattr(effects, "attach", lambda rows, tables, *a: lookups.extend(t.keys for t in tables) or attach(rows, tables, *a))
    found = [r.rmse for r in shared.richer().orderBy("step").collect()]
    assert lookups.count(("movieId",)) == 2 and lookups.count(("userId",)) == 2
    monkeypatch.undo()

    alone = ladder(rated)
    models = [alone.with_user_genre, alone.movie_bins, alone.user_drift, alone.factors, alone.genre_words]
    assert "scored_train" not in alone.__dict__
    errors = [rmse_of(m.predict(rated[1])).first().rmse for m in models]
    assert found == pytest.approx([alone.best(3).first().rmse, *errors], abs=1e-12)
    # What richer() has fitted scores rows as they come, as any other model does.
    models = [shared.with_user_genre, shared.movie_bins, shared.user_drift, shared.factors, shared.genre_words]
    assert [rmse_of(m.predict(rated[1])).first().rmse for m in models] == pytest.approx(errors, abs=1e-12)


def test_richer_takes_models_that_were_fitted_before(rated):
    first = ladder(rated)
    drift = first.user_drift
    found = {r.method: r.rmse for r in first.richer().collect()}
    assert first.user_drift is drift
    assert found == {r.method: pytest.approx(r.rmse, abs=1e-12) for r in ladder(rated).richer().collect()}


@pytest.mark.parametrize("small_bytes", [1 << 26, 0])
def test_predictions_at_several_points_equal_the_models(rated, small_bytes):
    train, validation = rated
    fitted = fit_grid(train, [MOVIE, USER, GENRE], [0.0, 2.0, 5.0])
    points = {"a": (3, 2.0), "b": (2, 5.0), "c": (0, 0.0), "d": (1, 2.0)}
    rows = validation.withColumn("id", F.monotonically_increasing_id())
    found = {r.id: r for r in fitted.predict(rows, points, small_bytes).collect()}
    assert len(found) == validation.count()
    for name, (levels, lam) in points.items():
        model = fitted.at(lam).only(*fitted.levels[:levels])
        for r in model.predict(rows).collect():
            assert found[r.id][name] == r.pred


def test_scored_rows_only_need_the_levels_left(rated):
    train, validation = rated
    plain = fit_effects(train, [MOVIE, USER, GENRE], 1.0)
    whole = plain.plus(train, USER_GENRE, 1.0)
    scored = plain.predict(train).select("userId", "genres", "rating", "pred")
    later = plain.after(3).plus(scored, USER_GENRE, 1.0)
    assert later.reads == ["userId", "genres", "pred"] and whole.reads == ["movieId", "userId", "genres"]
    rows = validation.withColumn("id", F.monotonically_increasing_id())
    expected = {r.id: r.pred for r in whole.predict(rows).collect()}
    given = plain.predict(rows).select("id", *later.reads)
    assert {r.id: r.pred for r in later.predict(given).collect()} == pytest.approx(expected, abs=1e-12)
    assert {r.id: r.pred for r in later.after(0).predict(rows).collect()} == pytest.approx(expected, abs=1e-12)
