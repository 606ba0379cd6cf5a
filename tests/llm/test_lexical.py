import math
import random
import re

import numpy as np
import pytest

from starfit.llm import lexical
from starfit.llm.k2treap import K2Treap, pack, unpack

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def terms_of(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """(item, rank, doc_id, score) by scoring every document for every item."""
    rows = [(i, terms_of(t)) for i, t in docs]
    rows = [(i, t) for i, t in rows if t]
    documents, total = len(rows), sum(len(t) for _, t in rows)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    holding: dict = {}
    for _, own in rows:
        for t in set(own):
            holding[t] = holding.get(t, 0) + 1
    out = []
    for item, own in asked.items():
        scores = []
        for doc_id, found in rows:
            m = 100 - 90 + (90 * len(found) * documents) // total
            score = 0
            for t in own & set(found):
                tf = found.count(t)
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[t] + 1)))
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, n, d, -s) for n, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found_rows(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


def test_treap_gives_the_points_back():
    draw = np.random.default_rng(5)
    for side, n in ((1, 1), (2, 3), (100, 700), (5000, 3000)):
        at = np.unique(draw.integers(0, side, (n, 2)), axis=0)
        weights = draw.integers(1, 600_000, len(at))
        treap = K2Treap.load(*K2Treap.build(at[:, 0], at[:, 1], weights))
        assert treap.largest == weights.max()
        for row in np.unique(at[:, 0])[:40]:
            cells, most, columns = np.zeros(1, np.int64), np.array([treap.largest]), np.zeros(1, np.int64)
            for depth in range(treap.height):
                halves = []
                for right in (0, 1):
                    there, c, m = treap.step(depth, np.full(len(cells), row), cells, most, right)
                    assert (m <= most[there]).all()
                    halves.append((c, m, 2 * columns[there] + right))
                cells, most, columns = (np.concatenate(x) for x in zip(*halves))
            own = at[:, 0] == row
            assert dict(zip(columns.tolist(), most.tolist())) == dict(zip(at[own, 1].tolist(), weights[own].tolist()))


def test_packed_numbers_come_back():
    for values in ([], [0], [1, 2**32 - 1, 77]):
        assert unpack(pack(np.array(values, np.uint32))).tolist() == values


@pytest.mark.parametrize(("block", "ranges", "item_bytes"), [(8 << 20, 256, 4 << 20), (900, 2, 400)])
def test_search_equals_scoring_everything(spark, docs, texts, monkeypatch, block, ranges, item_bytes):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "RANGES", ranges)
    monkeypatch.setattr(lexical, "ITEM_BYTES", item_bytes)
    draw = random.Random(8)
    words = sorted({w for t in texts.values() for w in terms_of(t)})
    items = [(k, " ".join(draw.choices(words, k=draw.randint(1, 12)))) for k in range(12)]
    items += [(50, texts[1]), (51, "SAME Words"), (52, "nowhere-at-all zzz"), (53, "ÜNÏCODE ünïcode"), (54, "aaaa")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert found_rows(lexical.search(lexical.build_index(docs), frame)) == brute(texts.items(), items)
    assert found_rows(lexical.search(lexical.build_index(docs), frame, k=3)) == brute(texts.items(), items, 3)


def test_odd_rows_ties_and_items(spark):
    """Nulls, repeats, copies beyond k, a hot term, very long terms and texts, clashing columns."""
    docs = [(None, "alpha beta"), (1, None), (2, ""), (3, "!? .."), (4, "alpha beta"), (4, "alpha beta")]
    docs += [(k, "alpha beta gamma") for k in range(100, 140)]
    docs += [(200, "x" * 70_000), (201, "long " * 30_000 + "alpha"), (202, "a_b a-b A.B 9é9")]
    items = [(1, "ALPHA, beta"), (1, "gamma"), (2, None), (3, ""), (None, "x" * 70_000), (4, "é9 9é9 a"), (5, "alpha")]
    rows = [(d, t, "s", 7) for d, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, terms string, score long").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    assert found_rows(lexical.search(lexical.build_index(frame), asked)) == brute(docs, items)
    none = frame.where("false")
    assert lexical.search(lexical.build_index(none), asked).count() == 0
    assert lexical.search(lexical.build_index(frame), asked.where("false")).count() == 0
    assert lexical.search(lexical.build_index(frame), asked).columns == ["item_id", "rank", "doc_id", "score"]
