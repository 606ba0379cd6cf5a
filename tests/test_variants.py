import itertools
import random

import numpy as np
import pytest

from starfit.operators import blend as blend_operators
from starfit.operators.backtest import backtest, time_origins
from starfit.operators.blend import blend_weights, blended, non_negative, out_of_fold
from starfit.operators.effects import GENRE, MOVIE, USER, fit_effects


@pytest.fixture(scope="module")
def rated(spark):
    """Keys that come up late, a hot user, tied and missing times, missing genres."""
    rng = random.Random(3)
    rows = []
    for k in range(500):
        when = rng.randrange(1000)
        user, movie = rng.choice([1, rng.randint(2, 6 + when // 60)]), rng.randint(1, 5 + when // 50)
        rows.append((user, movie, rng.randint(1, 10) / 2, when, [None, "A", "B"][movie % 3], k))
    rows += [(1, 1, 4.0, None, "A", 900), (1, 2, 3.0, 500, "B", 901), (2, 2, 3.0, 500, "B", 902)]
    schema = "userId int, movieId int, rating double, timestamp bigint, genres string, id int"
    return rows, spark.createDataFrame(rows, schema).repartition(4)


@pytest.mark.parametrize("small_bytes", [64 << 20, 0], ids=["broadcast", "shuffled"])
def test_backtest_equals_one_fit_an_origin(rated, small_bytes, no_auto_broadcast):
    rows, frame = rated
    origins = [200.5, 500.0, 990.0]
    found = {r.origin: r for r in backtest(frame, origins, 2.0, small_bytes).collect()}
    timed = [r for r in rows if r[3] is not None]
    for k, (start, stop) in enumerate(zip(origins, [*origins[1:], 1e9]), 1):
        past = [r for r in timed if r[3] < start]
        test = [r for r in timed if start <= r[3] < stop]
        known = [r for r in test if r[0] in {p[0] for p in past} and r[1] in {p[1] for p in past}]
        model = fit_effects(frame.filter(f"timestamp < {start}"), [MOVIE, USER], 2.0)
        b = {r.movieId: r.b_i for r in model.effects(MOVIE).collect()}
        u = {r.userId: r.b_u for r in model.effects(USER).collect()}
        r = found[k]
        assert (r.cutoff, r.n_train, r.n_test, r.n_known) == (start, len(past), len(test), len(known))
        assert len(known) < len(test) or k == 3
        assert r.mu == pytest.approx(np.mean([p[2] for p in past]))
        for name, off in (
            ("rmse_mean", lambda x: 0),
            ("rmse_movie", lambda x: b[x[1]]),
            ("rmse_movie_user", lambda x: b[x[1]] + u[x[0]]),
        ):
            expected = np.sqrt(np.mean([(x[2] - model.mu - off(x)) ** 2 for x in known]))
            assert r[name] == pytest.approx(expected, abs=1e-9)


def test_origins(rated):
    rows, frame = rated
    times = sorted(r[3] for r in rows if r[3] is not None)
    assert time_origins(frame, [0.5, 0.9]) == pytest.approx(np.quantile(times, [0.5, 0.9]).tolist())
    with pytest.raises(ValueError, match="rise"):
        backtest(frame, [5.0, 5.0], 1.0)
    late = backtest(frame, [-5.0, 5e9], 1.0).orderBy("origin").collect()  # no past, no future
    assert [(r.n_train, r.n_known, r.rmse_mean) for r in late] == [(0, 0, None), (502, 0, None)]


def test_no_row_is_scored_by_a_model_that_saw_it(rated):
    rows, frame = rated
    models = {"movie": [MOVIE], "user": [USER], "all": [MOVIE, USER, GENRE]}
    scored = out_of_fold(frame, models, 3, 1.0, ["id"])
    found = {r.id: r for r in scored.collect()}
    assert len(found) == len(rows) and {r.fold for r in found.values()} == {0, 1, 2}
    for fold, (name, levels) in itertools.product(range(3), models.items()):
        own = [i for i, r in found.items() if r.fold == fold]
        rest = frame.filter(~frame.id.isin(own))
        model = fit_effects(rest, levels, 1.0)
        for r in model.predict(frame.filter(frame.id.isin(own))).collect():
            assert found[r.id].mu == pytest.approx(model.mu)
            assert found[r.id][name] == pytest.approx(r.pred - model.mu, abs=1e-9)
    weights = blend_weights(scored, list(models))
    x = np.array([[r[m] for m in models] for r in found.values()])
    y = np.array([r.rating - r.mu for r in found.values()])
    assert list(weights.values()) == pytest.approx(non_negative(x.T @ x, x.T @ y), abs=1e-9)
    off = np.array([r.rating - r.pred for r in blended(scored, weights).collect()])
    assert (off**2).sum() <= min(((y - x[:, k]) ** 2).sum() for k in range(3)) + 1e-9


def test_weights_are_optimal_and_not_negative():
    draw = np.random.default_rng(2)
    for _ in range(50):
        x, y = draw.normal(size=(30, 4)), draw.normal(size=30)
        gram, sides = x.T @ x, x.T @ y
        w = non_negative(gram, sides)
        slope = gram @ w - sides  # the conditions of the best non-negative weights
        assert (w >= 0).all() and (slope >= -1e-9).all() and abs(slope @ w) < 1e-9


def test_rows_are_written_once_whatever_the_number_of_models(spark, monkeypatch):
    names = []
    real = blend_operators.stage
    monkeypatch.setattr(blend_operators, "stage", lambda frame, name: names.append(name) or real(frame, name))
    rows = [(k, k % 5, k % 7, float(k % 4)) for k in range(60)]
    frame = spark.createDataFrame(rows, "id int, userId int, movieId int, rating double")
    scored = out_of_fold(frame, {"movie": [MOVIE], "user": [USER], "both": [MOVIE, USER]}, 3, 1.0, ["id"])
    assert names == ["folds", "out-of-fold"] and scored.count() == 60
    assert scored.columns == ["id", "userId", "movieId", "rating", "fold", "movie", "mu", "user", "both"]
