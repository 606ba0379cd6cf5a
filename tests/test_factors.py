import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfit.operators import factors
from starfit.operators.effects import GENRE, MOVIE, USER, fit_effects
from starfit.operators.inner_product import recommend_by_factors, serve


@pytest.fixture(scope="module")
def rated(spark):
    """Ratings with a user of a third of all rows, repeated pairs and missing keys."""
    draw = random.Random(7)
    rows = [(1 if k % 3 == 0 else draw.randint(2, 25), draw.randint(1, 30), draw.randint(1, 10) / 2) for k in range(600)]
    rows += [(None, 3, 1.0), (4, None, 2.0), (77, 88, 5.0)]
    return spark.createDataFrame(rows, "userId int, movieId int, rating double").repartition(3)


def dense(left, first, rank, lam, iterations):
    """Factors by the textbook, one key at a time."""
    movies, users = {m: np.array(v) for m, v in first.items()}, {}

    def fit(own, other, side):
        found = {}
        for key in {r[side] for r in left}:
            x = np.array([other[r[1 - side]] for r in left if r[side] == key])
            y = np.array([r[2] for r in left if r[side] == key])
            found[key] = np.linalg.solve(x.T @ x + lam * np.eye(rank), x.T @ y)
        return found

    for _ in range(iterations):
        users = fit(users, movies, 0)
        movies = fit(movies, users, 1)
    return users, movies


@pytest.mark.parametrize("block_rows", [200_000, 40])
def test_factors_equal_dense_solves(rated, block_rows):
    base = fit_effects(rated, [MOVIE, USER], 1.0)
    model = factors.fit_factors(rated, base, 3, 0.7, 2, block_rows)
    left = [tuple(r) for r in factors.residuals(rated, base).collect()]
    keys = rated.select("movieId").distinct().where("movieId IS NOT NULL")
    first = dict(keys.select("movieId", factors.first_factors(F.col("movieId"), 3)).collect())
    users, movies = dense(left, first, 3, 0.7, 2)
    for table, name, expected in ((model.users, "_p", users), (model.movies, "_q", movies)):
        found = {r[0]: r[name] for r in table.frame.collect()}
        assert found.keys() == expected.keys() and len(found) == table.n_rows
        for key, value in expected.items():
            assert found[key] == pytest.approx(value, abs=1e-9)
    for r in model.predict(rated).collect():
        known = r.userId in users and r.movieId in movies
        assert r.b_f == pytest.approx(users[r.userId] @ movies[r.movieId] if known else 0.0, abs=1e-9)


def test_loss_never_rises(rated):
    base = fit_effects(rated, [MOVIE, USER], 1.0)
    losses = [
        factors.penalized_loss(rated, factors.fit_factors(rated, base, 4, 0.5, k, 100), 0.5) for k in (1, 2, 3)
    ]
    plain = rated.where("userId IS NOT NULL AND movieId IS NOT NULL")
    start = base.predict(plain).agg(F.sum((F.col("rating") - F.col("pred")) ** 2)).first()[0]
    assert start > losses[0] >= losses[1] >= losses[2]


def test_a_penalty_is_needed(rated):
    with pytest.raises(ValueError, match="positive"):
        factors.fit_factors(rated, fit_effects(rated, [MOVIE]), 2, 0.0, 1)


@pytest.mark.parametrize(("block", "chunk_bytes"), [(1024, 1 << 20), (2, 8 * 7 * 6)])
def test_best_movies_equal_ranking_all_pairs(rated, block, chunk_bytes):
    genres = F.when(F.col("movieId") % 4 == 0, None).otherwise((F.col("movieId") % 3).cast("string"))
    seen = rated.withColumn("genres", genres).where("userId IS NOT NULL")
    train = seen.where("movieId IS NOT NULL AND movieId % 5 <> 0 AND userId <> 7")
    base = fit_effects(train, [MOVIE, USER, GENRE], 1.0)
    model = factors.fit_factors(train, base, 3, 0.2, 2)
    found = recommend_by_factors(seen, model, 4, block=block, chunk_bytes=chunk_bytes).collect()
    users = {r.userId: np.array(r["_p"]) for r in model.users.frame.collect()}
    movies = {r.movieId: np.array(r["_q"]) for r in model.movies.frame.collect()}

    def effects(level):
        return {r[level.keys[0]]: r[level.effect] for r in base.effects(level).collect()}

    own, by_movie, by_genre = effects(USER), effects(MOVIE), effects(GENRE)
    pairs = [(r.userId, r.movieId, r.genres) for r in seen.collect()]
    expected = {}
    for u in {p[0] for p in pairs}:
        scored = []
        for m, g in {(m, g) for _, m, g in pairs if m is not None}:
            if m not in {x for v, x, _ in pairs if v == u}:
                score = by_movie.get(m, 0) + by_genre.get(g, 0)
                score += users[u] @ movies[m] if u in users and m in movies else 0
                scored.append((-round(score, 9), m))
        expected |= {(u, k): (m, base.mu + own.get(u, 0) - s) for k, (s, m) in enumerate(sorted(scored)[:4], 1)}
    assert {(r.userId, r["rank"]): (r.movieId, pytest.approx(r.pred, abs=1e-8)) for r in found} == expected
    if block == 2:
        n_blocks = -(-len({m for _, m, _ in pairs if m is not None}) // 2)
        assert min(r.blocks for r in found) < n_blocks  # the bound ends searches early


@pytest.mark.parametrize("n", [5, 300])
def test_users_of_typical_length_end_early_and_serve_equals_full_sorting(n):
    draw = np.random.default_rng(3)
    q, p = draw.normal(size=(4_000, 2)), draw.normal(size=(60, 2))
    p[:40] /= np.linalg.norm(p[:40], axis=1)[:, None]
    lengths = np.linalg.norm(q, axis=1)
    shared = draw.normal(size=4_000) * 3 - lengths  # large effects go with short vectors
    order = np.argsort(-(shared + lengths), kind="stable")
    ids, q, shared, lengths = draw.permutation(4_000)[order], q[order], shared[order], lengths[order]
    seen = [np.sort(draw.choice(4_000, 50, replace=False)) for _ in p]
    scores = np.round(p @ q.T + shared, 2)  # many ties
    none = [(np.zeros(0, np.int64), np.zeros(0)) for _ in p]
    early = 2_000
    halves = [(x[:early], x[early:]) for x in (ids, q, shared, lengths)]
    later = (shared + lengths)[early:].max(), lengths[early:].min(), lengths[early:].max()
    first, read, going = serve(p, none, [s[s < early] for s in seen], tuple(h[0] for h in halves), 1.0, later, n, 100, 2)
    end = (-np.inf, 0.0, 0.0)
    rest, _, more = serve(p, first, [s[s >= early] - early for s in seen], tuple(h[1] for h in halves), 1.0, end, n, 100, 2)
    assert not more.any() and (n > 5 or (read[:40] < 10).all() and not going[:40].any())
    for u in range(len(p)):
        free = np.setdiff1d(np.arange(4_000), seen[u])
        best = free[np.lexsort((ids[free], -scores[u, free]))][:n]
        assert rest[u][0].tolist() == ids[best].tolist() and rest[u][1].tolist() == scores[u, best].tolist()
