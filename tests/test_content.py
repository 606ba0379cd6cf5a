import random

import numpy as np
import pytest

from starfit.operators.content import GenreWords, MoviePrior
from starfit.operators.effects import GENRE, MOVIE, USER, fit_effects


def draw(spark, single=False, seed=2):
    rng = random.Random(seed)
    words = ["Drama", "Comedy", "War", "Noir", "Crime"]
    genres = {m: "|".join(rng.sample(words, 1 if single else rng.randint(1, 3))) for m in range(30)}
    genres[5], genres[6] = None, ""
    rows = []
    for _ in range(400):
        m = rng.choice([1, rng.randrange(30)])
        bonus = 0.6 if "War" in (genres[m] or "") else 0.0
        rows.append((rng.randint(1, 20), m, round(2 + bonus + m / 30 + rng.random(), 2), genres[m]))
    return rows, spark.createDataFrame(rows, "userId int, movieId int, rating double, genres string").repartition(3)


def words(genres):
    return {None} if genres is None else set(genres.split("|"))


@pytest.mark.parametrize("lam", [3.0, 0.0])
def test_weights_equal_ridge_on_rating_rows(spark, lam):
    rows, frame = draw(spark)
    base = fit_effects(frame, [MOVIE, USER], 1.0)
    fitted = GenreWords.fit(frame, base, lam)
    scored = base.predict(frame).collect()
    names = sorted({w for r in rows for w in words(r[3])}, key=lambda w: (w is not None, w))
    x = np.array([[w in words(r.genres) for w in names] for r in scored], float)
    y = np.array([r.rating - r.pred for r in scored])
    expected = np.linalg.lstsq(x.T @ x + lam * np.eye(len(names)), x.T @ y, rcond=None)[0]
    found = {r.word: r.weight for r in fitted.weights.collect()}
    assert found.keys() == set(names)
    if lam:
        assert [found[w] for w in names] == pytest.approx(expected, abs=1e-9)
    ask = spark.createDataFrame([(1, 2, 1.0, "War|Comedy|Opera"), (1, 2, 1.0, None), (1, 2, 1.0, "")], frame.schema)
    weight = dict(zip(names, expected))
    got = {r.genres: r.b_w for r in fitted.predict(ask).collect()}
    told = {"War|Comedy|Opera": weight["War"] + weight["Comedy"], None: weight[None], "": weight[""]}
    assert got == {g: pytest.approx(v, abs=1e-8) for g, v in told.items()}


def test_one_word_a_movie_is_the_shrunken_genre_effect(spark):
    _, frame = draw(spark, single=True)
    base = fit_effects(frame, [MOVIE, USER], 2.0)
    found = {r.word: (r.weight, r.n) for r in GenreWords.fit(frame, base, 2.0).weights.collect()}
    plain = fit_effects(frame, [MOVIE, USER, GENRE], 2.0).effects(GENRE).collect()
    assert found == {r.genres: (pytest.approx(r.b_g, abs=1e-9), r.n_g) for r in plain}


def test_prior_blends_by_moments(spark):
    rows, frame = draw(spark, seed=4)
    prior = MoviePrior.fit(frame, 1.0)
    mu = np.mean([r[2] for r in rows])
    names = sorted({w for r in rows for w in words(r[3])}, key=lambda w: (w is not None, w))
    x = np.array([[w in words(r[3]) for w in names] for r in rows], float)
    y = np.array([r[2] - mu for r in rows])
    weight = dict(zip(names, np.linalg.solve(x.T @ x + np.eye(len(names)), x.T @ y)))
    own = {}
    for r, v in zip(rows, y):
        own.setdefault(r[1], []).append(v)
    genres = {r[1]: r[3] for r in rows}
    said = {m: sum(weight[w] for w in words(genres[m])) for m in own}
    within = sum(len(v) * np.var(v) for v in own.values()) / (len(rows) - len(own))
    outside = sum(len(v) * (np.mean(v) - said[m]) ** 2 for m, v in own.items())
    between = max(0.0, (outside - len(own) * within) / len(rows))
    assert (prior.mu, prior.within, prior.between) == pytest.approx((mu, within, between))
    assert between > 0
    found = {r.movieId: r.b_i for r in prior.movies.frame.collect()}
    for m, v in own.items():
        trust = len(v) * between / (len(v) * between + within)
        assert found[m] == pytest.approx(said[m] + trust * (np.mean(v) - said[m]))
    ask = spark.createDataFrame([(1, 900, 1.0, "War"), (1, 901, 1.0, "Opera"), (1, None, 1.0, None)], frame.schema)
    got = {r.movieId: (r.n_i, r.pred) for r in prior.predict(ask).collect()}
    assert got[900] == (0, pytest.approx(mu + weight["War"])) and got[901] == (0, pytest.approx(mu))
    assert got[None] == (0, pytest.approx(mu + weight[None]))
