import random
import re

import pytest

from starfit.operators import keyed, recommend
from starfit.operators.effects import GENRE, MOVIE, USER, USER_GENRE, fit_effects


def draw_seen(seed):
    """Ratings with a user who has seen nearly all, one who has seen one, and missing genres."""
    draw = random.Random(seed)
    genres = {m: draw.choice(["A", "B", "C|D", None, "E"]) for m in range(40)}
    rows = [(u, m) for u in range(12) for m in range(40) if draw.random() < (0.93 if u == 0 else 0.15)]
    rows += [(99, 3)] + draw.choices(rows, k=10)  # seen twice
    return [(u, m, draw.randint(1, 10) / 2, genres[m]) for u, m in rows]


def by_all_pairs(rows, model, n):
    def effects(level):
        return {tuple(r[k] for k in level.keys): r[level.effect] for r in model.effects(level).collect()}

    movie, user, genre, own = (effects(level) for level in (MOVIE, USER, GENRE, USER_GENRE))
    genres: dict = {}
    for _, m, _, g in rows:
        genres.setdefault(m, set()).add(g)
    genres = {m: min((g for g in gs if g is not None), default=None) for m, gs in genres.items()}
    out = {}
    for u in {r[0] for r in rows}:
        seen = {m for v, m, _, _ in rows if v == u}
        scored = []
        for m, g in genres.items():
            if m not in seen:
                shared, shift = movie.get((m,), 0) + genre.get((g,), 0), own.get((u, g), 0)
                pred = model.mu + user.get((u,), 0) + shared + shift
                scored.append((-round(shared * 1e9) - round(shift * 1e9), m, pred))
        out |= {(u, k): (m, round(p, 9)) for k, (_, m, p) in enumerate(sorted(scored)[:n], 1)}
    return out


@pytest.mark.parametrize(("seed", "n"), [(1, 3), (3, 60)])
def test_merged_lists_equal_ranking_all_pairs(spark, seed, n):
    rows = draw_seen(seed)
    train = spark.createDataFrame(rows, "userId int, movieId int, rating double, genres string")
    half = train.filter("movieId % 4 <> 0")  # some movies, and genres of users, are new to the model
    model = fit_effects(half, [MOVIE, USER, GENRE], 1.0).plus(half, USER_GENRE, 1.0)
    found = recommend.recommend(train.select("userId", "movieId", "genres"), model, n).collect()
    assert {(r.userId, r["rank"]): (r.movieId, round(r.pred, 9)) for r in found} == by_all_pairs(rows, model, n)


def test_the_lists_kept_for_all_users_are_not_broadcast(spark):
    train = spark.createDataFrame(draw_seen(2), "userId int, movieId int, rating double, genres string")
    model = fit_effects(train, [MOVIE, USER, GENRE], 1.0).plus(train, USER_GENRE, 1.0)
    found = recommend.recommend(train.select("userId", "movieId", "genres"), model, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"(\w+Join) [^\n]*_skipped#\d+L? < [^\n]*_need#", plan) == ["SortMergeJoin"]


def test_other_levels_are_refused(spark, mini_train):
    model = fit_effects(mini_train, [MOVIE])
    odd = keyed.KeyedTable.write(mini_train.select("userId", "movieId").distinct(), ["userId", "movieId"], "odd")
    level = type(MOVIE)(("userId", "movieId"), "b", "n")
    model = type(model)(model.mu, (*model.levels, level), (*model.tables, odd))
    with pytest.raises(ValueError, match="differently"):
        recommend.recommend(mini_train, model, 2)
