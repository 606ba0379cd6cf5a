import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from starfit.llm import components, ngram_join, suffix_dedup
from starfit.llm.arrays import flat


def _removed(docs):
    found = suffix_dedup.remove_repeats(docs).withColumn("sha", F.sha2("kept", 256))
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.sha)) for r in found.collect()]


def test_repeats_equal_brute_force(docs, texts):
    found = _removed(docs)
    assert dict(found) == brute.without_repeats(texts)
    assert len(found) == len(texts)


def test_short_matches_and_periodic_texts(spark):
    """Matches of exactly the length, one less, at the edges, in texts that repeat themselves."""
    draw = np.random.default_rng(9)
    letters = lambda n: "".join(draw.choice(list("abcdefgh"), n))
    fifty, less = letters(50), letters(49)
    rows = {
        1: letters(30) + fifty + letters(20) + less,
        2: fifty + letters(10),
        3: letters(15) + less + letters(15),
        4: letters(9) + fifty,
        5: "ab" * 100,
        6: "ba" * 40,
        7: "a" * 49,
        8: "a" * 500,
        9: "a" * 51,
        10: letters(3) + fifty[1:] + fifty,
    }
    found = _removed(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
    assert dict(found) == brute.without_repeats(rows)


def test_repeats_on_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert dict(_removed(docs)) == brute.without_repeats(texts)


def test_repeats_with_odd_rows(odd_docs, no_docs):
    found = sorted(_removed(odd_docs), key=str)
    sizes = [(i, n, gone) for i, (n, gone, *_) in found]
    whole = 269
    assert sizes.count((1, whole, 0)) == 2
    assert (2, whole, whole) in sizes and (3, whole, whole) in sizes
    assert (None, whole, 0) in sizes and (4, 0, 0) in sizes
    assert _removed(no_docs) == []
    left = suffix_dedup.without_repeats(odd_docs)
    assert left.columns == odd_docs.columns
    assert {r.text for r in left.where("doc_id = 2").collect()} == {""}
    assert left.where("doc_id = 4").first().text is None


def test_similar_documents_equal_brute_force(docs, texts):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()}
    assert found == brute.jaccard_components(texts)


def test_similar_documents_on_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()}
    assert found == brute.jaccard_components(texts)


def test_similar_documents_with_odd_rows(odd_docs, no_docs):
    found = [(r.doc_id, r.component_id) for r in ngram_join.similar_documents(odd_docs).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, 1), (1, 1), (2, 1), (3, 3), (3, 1), (None, 1), (None, None), (4, 4)], key=str
    )
    assert ngram_join.similar_documents(no_docs).count() == 0
    one = ngram_join.one_of_each(odd_docs)
    assert one.columns == odd_docs.columns
    assert sorted((r.doc_id for r in one.collect()), key=str) == sorted([1, 3, 3, 4, None, None], key=str)


@pytest.mark.parametrize("like", [ngram_join.Likeness(), ngram_join.Likeness(k2=0, n2=1), ngram_join.Likeness(k2=2, n2=5)])
def test_similar_sets_share_a_signature(like):
    """Sets at the very bound, of all small sizes and some larger ones."""
    import pyarrow as pa  # noqa: F401

    draw = np.random.default_rng(2)
    for size in [*range(1, 40), 77, 150, 400]:
        for other in range(size, min(size * 100 // like.percent, size + 12) + 1):
            # The least intersection that still links the two sizes.
            least = -(-(size + other) * like.percent // (100 + like.percent))
            if least > size:
                continue
            pool = draw.integers(1, 1 << 62, size + other, dtype=np.int64).astype(np.uint64)
            a, b = pool[:size], np.concatenate([pool[:least], pool[size : size + other - least]])
            rows = np.concatenate([np.zeros(size, int), np.ones(other, int)])
            hashes = np.concatenate([np.sort(a), np.sort(b)])
            with np.errstate(over="ignore"):
                own, signed = ngram_join.signatures(rows, hashes, np.array([size, other]), like)
            assert set(signed[own == 0].tolist()) & set(signed[own == 1].tolist()), (size, other)


def test_sketches_never_rule_out_a_similar_pair():
    draw = np.random.default_rng(4)
    like = ngram_join.Likeness()
    for size, other in [(20, 20), (60, 70), (300, 390), (63, 65)]:
        least = -(-(size + other) * 75 // 175)
        pool = draw.integers(1, 1 << 62, size + other, dtype=np.int64).astype(np.uint64)
        sets = [pool[:size], np.concatenate([pool[:least], pool[size : size + other - least]])]
        sizes = np.array([size, other])
        with np.errstate(over="ignore"):
            sketches = [ngram_join.sketch(s, int(n)) for s, n in zip(sets, ngram_join.sketch_bits(sizes))]
        table = ngram_join.Sketches(sketches, sizes, like)
        for forest in (True, False):
            assert ngram_join.open_pairs(np.arange(2), np.arange(2), table, forest).tolist() == [[0, 1]]


@pytest.mark.parametrize("batched", [1, 64])
def test_split_groups_lose_no_pair(docs, texts, monkeypatch, batched):
    monkeypatch.setattr(ngram_join, "FEW", 2)
    monkeypatch.setattr(ngram_join, "FORESTS", 1)
    monkeypatch.setattr(ngram_join, "BATCHED", batched)
    monkeypatch.setattr(ngram_join, "PAIRS_AT_ONCE", 3)
    monkeypatch.setattr(ngram_join, "GROUP", 2)
    monkeypatch.setattr(ngram_join, "MANY_HERE", 1)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()}
    assert found == brute.jaccard_components(texts)


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.id: r.component for r in components.connected_components(links).collect()}
    assert found == {**{k: 1 for k in range(1, 61)}, 100: 100, 101: 100}
    assert components.connected_components(links.where("a < 0")).count() == 0


def test_text_bytes_of_sliced_arrays():
    import pyarrow as pa

    data, offsets = flat(pa.array(["ab", None, "cde", ""]).slice(1, 2))
    assert data.tobytes() == b"cde" and offsets.tolist() == [0, 0, 3]


@pytest.mark.parametrize(("here", "few"), [(16, 8), (1, 2), (2, 4), (1, 8)])
def test_all_pairs_that_share_a_signature_are_listed(docs, texts, monkeypatch, here, few):
    """Whether they meet in a block, in a bucket, or one side in either."""
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "MANY_HERE", here)
    monkeypatch.setattr(ngram_join, "FEW", few)
    like = ngram_join.Likeness()
    data, offsets = flat(pa.array(list(texts.values())))
    with np.errstate(over="ignore"):
        rows, hashes = ngram_join.shingle_sets(data, offsets, 5)
        own, signed = ngram_join.signatures(rows, hashes, np.bincount(rows, minlength=len(texts)), like)
        nodes = ngram_join.fingerprints(rows, hashes, len(texts))[own]
    groups: dict[int, set[int]] = {}
    for s, n in zip(signed.tolist(), nodes.tolist()):
        groups.setdefault(s, set()).add(n)
    pairs = lambda sets: {(a, b) for g in sets for a in g for b in g if a < b}
    members: dict[int, set[int]] = {}
    listed = set()
    shared = ngram_join._shared_signatures(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), like)
    for r in shared.collect():
        if r.other is None:
            members.setdefault(r.signature, set()).add(r.node)
        else:
            listed.add((r.node, r.other))
    assert pairs(groups.values()) == listed | pairs(members.values())


def test_periodic_texts_are_few_entries():
    """A run of one byte, and short periods, do not fill a bucket."""
    for unit in (b"a", b"ab", b"abcdefg "):
        data = np.frombuffer(unit * (80_000 // len(unit)), np.uint8)
        with np.errstate(over="ignore"):
            found = suffix_dedup.Phrases(data, np.array([0, len(data)]))
        first, again = suffix_dedup.runs(found.rows, found.content, found.lo, found.windows)
        assert len(first) < 40 < len(found.lo)
        times = np.maximum(again // suffix_dedup.SPAN, 1)
        assert times.sum() == len(found.lo)


@pytest.mark.parametrize("size", [3_000, 400_000])
def test_removal_from_periodic_and_very_long_texts(spark, size):
    draw = random.Random(3)
    prose = "".join(draw.choices("abcdefgh ", k=size))
    texts = {1: "x" * 300, 2: "x" * size, 3: "ab" * (size // 2) + prose[:200], 4: prose, 5: "q" + "ab" * 99 + "z" * 60}
    texts |= {6: prose[size // 3 : size // 2] + "tail " * 50, 7: "z" * 70, 8: "ail t" * 40}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    seen: dict[str, int] = {}
    for i, t in sorted(texts.items()):
        for k in range(len(t) - 49):
            seen.setdefault(t[k : k + 50], i)
    for r in suffix_dedup.remove_repeats(frame).collect():
        t = texts[r.doc_id]
        gone = np.zeros(len(t) + 1, int)
        for k in range(len(t) - 49):
            if seen[t[k : k + 50]] < r.doc_id:
                gone[k] += 1
                gone[k + 50] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        assert bytes(r.kept).decode() == "".join(c for c, g in zip(t, gone) if not g)
        assert r.n_removed == gone.sum() and r.n_spans == (gone & ~np.append(False, gone[:-1])).sum()
