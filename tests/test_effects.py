import re

import pytest
from pyspark.sql import functions as F

from starfit.functions import lambda_grid, rmse
from starfit.operators import keyed
from starfit.operators.diagnostics import rmse_of
from starfit.operators.effects import GENRE, MOVIE, USER, EffectsModel, fit_effects, fit_grid
from starfit.operators.sweep import best_lambda, errors_at, lambda_curve, mark_best
from starfit.plans.ladder import Ladder

LEVELS = [MOVIE, USER, GENRE]

GOLDEN = {
    0.0: {
        "b_i": {10: 1.166667, 20: -1.083333, 30: -1.333333},
        "b_u": {1: 0.625, 2: -0.25, 3: -0.375},
        "b_g": {"Comedy|Drama": -0.125, "Drama": 0.0, None: 0.25},
        "pred": [2.875, 1.875, 2.958333, 4.5],
        "rmse": [0.565194, 0.737159, 0.793310, 0.870774],
    },
    1.0: {
        "b_i": {10: 0.875, 20: -0.722222, 30: -0.666667},
        "b_u": {1: 0.393519, 2: -0.291667, 3: -0.273148},
        "b_g": {"Comedy|Drama": -0.280864, "Drama": 0.261574, None: -0.1875},
        "pred": [2.872685, 2.03858, 3.060185, 4.469907],
        "rmse": [0.565194, 0.493056, 0.662296, 0.790423],
    },
}
COUNTS = {"n_i": {10: 3, 20: 2, 30: 1}, "n_u": {1: 2, 2: 2, 3: 2}, "n_g": {"Comedy|Drama": 2, "Drama": 3, None: 1}}


@pytest.mark.parametrize("small_bytes", [64 << 20, 0], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("lam", [0.0, 1.0])
def test_golden_effects_and_predictions(
    mini_train, mini_validation, lam, small_bytes, no_auto_broadcast
):
    model = fit_effects(mini_train, LEVELS, lam, small_bytes)
    assert model.mu == pytest.approx(20 / 6)
    for level in LEVELS:
        rows = model.effects(level).collect()
        key = level.keys[0]
        assert {r[key]: round(r[level.effect], 6) for r in rows} == GOLDEN[lam][level.effect]
        assert {r[key]: r[level.count] for r in rows} == COUNTS[level.count]
    scored = model.predict(mini_validation, small_bytes)
    assert scored.columns == [*mini_validation.columns, "b_i", "b_u", "b_g", "pred"]
    by_user = {(r.userId, r.movieId): round(r.pred, 6) for r in scored.collect()}
    keys = [(1, 30), (2, 20), (3, 40), (9, 10)]
    assert by_user == dict(zip(keys, GOLDEN[lam]["pred"]))
    for depth, expected in enumerate(GOLDEN[lam]["rmse"]):
        cut = model.only(*LEVELS[:depth])
        assert rmse_of(cut.predict(mini_validation)).first().rmse == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("small_bytes", [64 << 20, 0], ids=["broadcast", "shuffled"])
def test_sweep_equals_one_fit_per_lambda(
    mini_train, mini_validation, small_bytes, no_auto_broadcast
):
    grid = lambda_grid()
    fitted = fit_grid(mini_train, LEVELS, grid, small_bytes)
    curve = {r["lambda"]: r.rmse for r in lambda_curve(mini_validation, fitted, small_bytes).collect()}
    assert sorted(curve) == grid and len(grid) == 41
    for lam in (0.0, 5.0, 10.0):
        scored = fit_effects(mini_train, LEVELS, lam).predict(mini_validation)
        assert rmse_of(scored).first().rmse == pytest.approx(curve[lam], abs=1e-12)
    two = errors_at(mini_validation, fitted, [(2, 0.0), (2, 1.0)], small_bytes).collect()
    assert [round(r.rmse, 6) for r in two] == [GOLDEN[0.0]["rmse"][2], GOLDEN[1.0]["rmse"][2]]


def test_user_only_model(mini_train, mini_validation):
    scored = fit_effects(mini_train, [USER]).predict(mini_validation)
    assert rmse_of(scored).first().rmse == pytest.approx(0.8579691784, abs=1e-10)


def test_order_of_levels_matters(mini_train):
    one = fit_effects(mini_train, [MOVIE, USER]).effects(USER).orderBy("userId").collect()
    other = fit_effects(mini_train, [USER, MOVIE]).effects(USER).orderBy("userId").collect()
    assert [round(r.b_u, 6) for r in one] != [round(r.b_u, 6) for r in other]
    with pytest.raises(ValueError):
        fit_effects(mini_train, [MOVIE, USER]).only(USER)


def test_unshrunken_movie_residuals_sum_to_zero(mini_train):
    model = fit_effects(mini_train, [MOVIE])
    sums = model.predict(mini_train).groupBy("movieId").agg(F.sum(F.col("rating") - F.col("pred")).alias("s"))
    assert all(abs(r.s) < 1e-9 for r in sums.collect())


def test_effects_shrink_as_lambda_grows(mini_train):
    fitted = fit_grid(mini_train, [MOVIE], [0.0, 1.0, 4.0])
    sizes = [
        {r.movieId: abs(r.b_i) for r in fitted.at(lam).effects(MOVIE).collect()}
        for lam in (0.0, 1.0, 4.0)
    ]
    for a, b in zip(sizes, sizes[1:]):
        assert all(b[k] <= a[k] for k in a)


def test_missing_rating_is_refused(spark, mini_train):
    broken = mini_train.unionByName(mini_train.limit(1).withColumn("rating", F.lit(None).cast("double")))
    with pytest.raises(ValueError, match="rating"):
        fit_effects(broken, [MOVIE])


def test_rating_that_is_no_number_is_refused(mini_train):
    broken = mini_train.withColumn("rating", F.when(F.col("userId") == 1, float("nan")).otherwise(F.col("rating")))
    with pytest.raises(ValueError, match="not a number"):
        fit_effects(broken, [MOVIE])


def test_a_grid_without_zero(mini_train, mini_validation):
    ladder = Ladder(mini_train, mini_validation, (1.0, 2.0))
    rows = {r.step: r.rmse for r in ladder.validation_errors().collect()}
    assert rows[4] == pytest.approx(GOLDEN[0.0]["rmse"][2], abs=1e-6)
    assert {r["lambda"] for r in ladder.curve(3).collect()} == {1.0, 2.0}
    assert rows[6] == pytest.approx(min(r.rmse for r in ladder.curve(3).collect()))


def test_ties_go_to_the_smaller_lambda(spark):
    curve = spark.createDataFrame([(2.0, 0.5), (1.0, 0.5), (0.0, 0.9)], "lambda double, rmse double")
    assert best_lambda(curve).first()["lambda"] == 1.0
    assert [r["lambda"] for r in mark_best(curve).filter("is_best").collect()] == [1.0]


def test_saved_model_predicts_the_same(spark, tmp_path, mini_train, mini_validation):
    model = fit_effects(mini_train, LEVELS, 1.0)
    model.save(str(tmp_path / "m"))
    back = EffectsModel.load(spark, str(tmp_path / "m"), LEVELS)
    ours = sorted(r.pred for r in model.predict(mini_validation).collect())
    assert ours == sorted(r.pred for r in back.predict(mini_validation).collect())


def test_scoring_twice_replaces_the_first(mini_train, mini_validation):
    model = fit_effects(mini_train, LEVELS, 1.0)
    once = model.predict(mini_validation)
    again = fit_effects(mini_train, [MOVIE]).predict(once)
    assert sorted(again.columns) == sorted(once.columns)
    assert {r.movieId: round(r.pred, 6) for r in again.collect()}[20] == round(20 / 6 - 1.083333333, 6)


def test_rmse_of_exact_predictions_is_zero(mini_train):
    assert mini_train.agg(rmse(F.col("rating"), F.col("rating")).alias("e")).first().e == 0.0


def test_added_level_equals_fitting_it_in_order(mini_train):
    whole = fit_effects(mini_train, LEVELS, 1.0)
    grown = fit_effects(mini_train, [MOVIE, USER], 1.0).plus(mini_train, GENRE, 1.0)
    as_dict = lambda m: {r.genres: (round(r.b_g, 12), r.n_g) for r in m.effects(GENRE).collect()}
    assert as_dict(whole) == as_dict(grown)


def test_narrowed_tables_know_their_size(mini_train):
    fitted = fit_grid(mini_train, LEVELS, lambda_grid())
    lazy, written = fitted.at(1.0), fitted.at(1.0).written()
    assert [t.n_bytes for t in lazy.tables] == [t.n_bytes for t in written.tables]
    assert all(t.n_bytes < 200 * t.n_rows for t in written.tables)


@pytest.mark.parametrize("points", [82, 101])
def test_sweep_keeps_generated_code(mini_train, mini_validation, points):
    """Every aggregate of the sweep has a stage of generated code, for wide grids too."""
    grid = [0.1 * k for k in range(points)]
    fitted = fit_grid(mini_train, [MOVIE, USER], grid)
    curve = lambda_curve(mini_validation, fitted)
    curve.collect()
    lines = curve._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    aggregates = [x for x in lines if "HashAggregate" in x]
    assert aggregates and all(re.search(r"\*\(\d+\)", x) for x in aggregates)
    assert curve.count() == points


def test_hot_keys_are_counted_once_per_key(mini_train, monkeypatch, no_auto_broadcast):
    counted = []
    monkeypatch.setattr(
        keyed, "hot_keys", lambda rows, keys, total=None, own=keyed.hot_keys: (counted.append(tuple(keys)), own(rows, keys, total))[1]
    )
    hot = keyed.HotKeys(mini_train)
    fitted = fit_grid(mini_train, [MOVIE, USER, GENRE], [0.0, 1.0, 2.0], small_bytes=0, hot=hot)
    assert sorted(counted) == [("genres",), ("movieId",), ("userId",)]
    fitted.at(1.0).predict(mini_train, small_bytes=0, hot=hot).collect()
    assert len(counted) == 3
