import random

import numpy as np
import pytest

from starfit.operators.effects import MOVIE, USER, fit_effects
from starfit.operators.timed import DAY, YEAR, MovieBins, UserDrift, banded_effects

WEEK = 7 * DAY


@pytest.fixture(scope="module")
def rated(spark):
    """Ratings that drift, with a hot movie, empty bins, a movie of one bin and missing times."""
    draw = random.Random(5)
    rows = []
    for _ in range(500):
        movie = draw.choice([1, 1, 2, 3, draw.randint(4, 9)])
        week = draw.choice([0, 1, 2, 3, 9, 10, 30])
        rating = round(3 + movie / 9 + week / 30 + draw.random(), 2)
        rows.append((draw.randint(1, 12), movie, rating, -2 * WEEK + week * WEEK + draw.randrange(WEEK)))
    rows += [(3, 50, 4.0, 5 * WEEK), (4, None, 2.0, 0), (5, 1, 1.0, None), (77, 1, 2.5, 12)]
    return rows, spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp bigint")


def residuals(rows, frame, levels):
    model = fit_effects(frame, levels, 1.0)
    scored = model.predict(frame).collect()
    return model, [(r.userId, r.movieId, r.timestamp, r.rating - r.pred) for r in scored if r.timestamp is not None]


@pytest.mark.parametrize(("smooth", "ridge"), [(0.0, 0.0), (4.0, 0.0), (1.5, 2.0)])
def test_bins_equal_a_dense_solve(rated, smooth, ridge):
    rows, frame = rated
    model, left = residuals(rows, frame, [MOVIE, USER])
    fitted = MovieBins.fit(frame, model, WEEK, smooth, ridge)
    found = {(r.movieId, r.bin): (r.b_it, r.n_it) for r in fitted.effects.collect()}
    expected = {}
    for movie in {m for _, m, _, _ in left}:
        bins = sorted({t // WEEK for _, m, t, _ in left if m == movie})
        # Every bin from the first to the last, those without rows, too.
        span = range(bins[0], bins[-1] + 1) if smooth else bins
        place = {b: k for k, b in enumerate(span)}
        a, s = np.zeros((len(span), len(span))), np.zeros(len(span))
        for _, m, t, r in left:
            if m == movie:
                a[place[t // WEEK], place[t // WEEK]] += 1
                s[place[t // WEEK]] += r
        counts = a.diagonal().copy()
        for b in bins:
            a[place[b], place[b]] += ridge
        for k in range(len(span) - 1) if smooth else ():
            a[k, k] += smooth
            a[k + 1, k + 1] += smooth
            a[k, k + 1] -= smooth
            a[k + 1, k] -= smooth
        x = np.linalg.solve(a, s)
        expected |= {(movie, b): (x[place[b]], counts[place[b]]) for b in bins}
        if movie == 1 and smooth:
            between = {b: x[place[b]] for b in span}
    assert found.keys() == expected.keys()
    for key, (effect, n) in expected.items():
        assert found[key] == (pytest.approx(effect, abs=1e-9), n)
    ask = frame.sparkSession.createDataFrame(
        [(1, 1, 1.0, b * WEEK + 5) for b in (-9, 1, 3, 17, 90)] + [(1, 60, 1.0, 0), (1, 1, 1.0, None)], frame.schema
    )
    got = {(r.movieId, None if r.timestamp is None else r.timestamp // WEEK): r.b_it for r in fitted.predict(ask).collect()}
    assert got[60, 0] == 0 and got[1, None] == 0
    if smooth:
        first, last = min(between), max(between)
        for b in (-9, 1, 3, 17, 90):
            assert got[1, b] == pytest.approx(between[min(max(b, first), last)], abs=1e-9)
    else:
        assert got[1, 17] == 0 and got[1, -9] == 0


def test_drift_equals_ridge_regression(rated):
    rows, frame = rated
    model, left = residuals(rows, frame, [MOVIE, USER])
    fitted = UserDrift.fit(frame, model, 2.0)
    origin = np.mean([t for *_, t in rows if t is not None])
    assert fitted.origin == pytest.approx(origin)
    found = {r.userId: (r.a_u, r.d_u, r.n_u) for r in fitted.table.frame.collect()}
    users = {u for u, *_ in left}
    assert found.keys() == users
    for user in users:
        x = np.array([[1, (t - origin) / YEAR] for u, _, t, _ in left if u == user])
        y = np.array([r for u, _, _, r in left if u == user])
        a, d = np.linalg.solve(x.T @ x + 2 * np.eye(2), x.T @ y)
        assert found[user] == (pytest.approx(a, abs=1e-9), pytest.approx(d, abs=1e-9), len(y))
    ask = frame.sparkSession.createDataFrame([(1, 1, 1.0, 99), (500, 1, 1.0, 99), (1, 1, 1.0, None)], frame.schema)
    base = {(r.userId, r.timestamp): r.pred for r in model.predict(ask).collect()}
    got = {(r.userId, r.timestamp): r.pred for r in fitted.predict(ask).collect()}
    a, d, _ = found[1]
    assert got[1, 99] == pytest.approx(base[1, 99] + a + d * (99 - origin) / YEAR)
    assert got[500, 99] == base[500, 99] and got[1, None] == base[1, None]


@pytest.mark.parametrize(("smooth", "ridge"), [(0.0, 0.0), (3.0, 0.0), (3.0, 1.5)])
def test_many_movies_solved_at_once_equal_dense_solves(smooth, ridge):
    draw = np.random.default_rng(1)
    sizes = [3, 1, 0, 7, 2, 7, 1]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    bins = np.concatenate([np.sort(draw.choice(40, k, replace=False)) for k in sizes])
    n, s = draw.integers(1, 9, len(bins)), draw.normal(size=len(bins))
    found = banded_effects(offsets, bins, n, s, smooth, ridge)
    for a, b in zip(offsets, offsets[1:]):
        system = np.diag(n[a:b] + ridge)
        for k in range(b - a - 1):
            pull = smooth / (bins[a + k + 1] - bins[a + k])
            system[k : k + 2, k : k + 2] += pull * np.array([[1, -1], [-1, 1]])
        if a < b:
            assert found[a:b] == pytest.approx(np.linalg.solve(system, s[a:b]), abs=1e-12)
    assert len(banded_effects(np.zeros(1, int), bins[:0], n[:0], s[:0], smooth, ridge)) == 0
