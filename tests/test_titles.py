import math
import random

import pytest

from starfit.operators import titles as operators
from starfit.operators.titles import block_ends, similar_titles


def by_all_pairs(titles, k):
    words = {m: set(t.lower().split()) for m, t in titles.items() if t and t.split()}
    holding: dict = {}
    for own in words.values():
        for w in own:
            holding[w] = holding.get(w, 0) + 1
    rarity = {w: math.log(1 + len(words) / n) for w, n in holding.items()}
    length = {m: math.sqrt(sum(rarity[w] ** 2 for w in own)) for m, own in words.items()}
    out = {}
    for a, own in words.items():
        scored = []
        for b, others in words.items():
            score = round(sum(rarity[w] ** 2 for w in own & others) / length[a] / length[b], 9)
            if a != b and score > 0:
                scored.append((-score, b))
        out |= {(a, n): (b, -s) for n, (s, b) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize(("first", "largest", "small_bytes"), [(64, 32_768, 64 << 20), (2, 16, 0)])
def test_similar_titles_equal_comparing_all_pairs(spark, first, largest, small_bytes, no_auto_broadcast):
    draw = random.Random(2)
    rare = [f"word{k}" for k in range(40)]
    titles = {m: " ".join(["The", *draw.choices(rare, k=draw.randint(1, 4))]) for m in range(120)}
    titles |= {200: None, 201: "", 202: "  ", 203: "alone", 204: "The", 205: "the  THE", 206: titles[3], 207: "Word1 word2"}
    movies = spark.createDataFrame(list(titles.items()), "movieId int, title string").repartition(3)
    found = similar_titles(movies, 5, first, largest, small_bytes).collect()
    got = {(r.movieId, r["rank"]): (r.similar, pytest.approx(r.similarity, abs=2e-9)) for r in found}
    assert len(got) == len(found) and got == by_all_pairs(titles, 5)


def test_blocks_grow_up_to_the_largest():
    assert block_ends(2, 16, 50) == [2, 18, 34, 50]
    assert block_ends(64, 32_768, 3) == [3] and block_ends(64, 32_768, 0) == [0]


def test_copies_of_a_title_are_compared_once(spark, monkeypatch):
    titles = {m: ("large ring", "hot ring", "large bolt", "Ring LARGE")[m % 4] for m in range(400)}
    sizes = []
    real = operators.attach

    def counted(rows, tables, *rest):
        if any(t.keys == ("similar",) and "_theirs" in t.frame.columns for t in tables):
            sizes.append(rows.count())
        return real(rows, tables, *rest)

    monkeypatch.setattr(operators, "attach", counted)
    movies = spark.createDataFrame([*titles.items(), (None, "hot ring")], "movieId int, title string")
    found = similar_titles(movies, 3).collect()
    got = {(r.movieId, r["rank"]): r.similar for r in found}
    assert max(sizes) <= 9 and len(got) == 3 * len(titles)
    assert [got[0, i] for i in (1, 2, 3)] == [3, 4, 7] and [got[5, i] for i in (1, 2, 3)] == [1, 9, 13]
    assert all(r.similarity == 1 for r in found)
