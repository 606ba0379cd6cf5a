import zlib

import brute
import numpy as np
import pytest

from starfit.llm import quality_model, quality_rules, toxicity
from starfit.llm.arrays import Words, flat


def test_counts_equal_brute_force(docs, texts):
    found = {r.doc_id: r for r in quality_rules.compression_bands(docs).collect()}
    assert set(found) == set(texts)
    for i, text in texts.items():
        r = found[i]
        said = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert said == brute.rule_counts(text), i
        assert not (r.kept and r.base_failed)


def test_bands_reject_repetition_and_noise(spark):
    draw = np.random.default_rng(1)
    prose = " ".join("".join(draw.choice(list("etaoinshrdlu"), draw.integers(2, 8))) for _ in range(600))
    letters = np.array([chr(c) for c in range(0x4E00, 0x9000)])
    noise = " ".join("".join(draw.choice(letters, 60)) for _ in range(30))
    drum = " ".join(f"item {k % 7} of {k % 5}" + "." * (k % 3) for k in range(600))
    rows = spark.createDataFrame([(1, prose), (2, noise), (3, drum)], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality_rules.compression_bands(rows).collect()}
    assert kept == {1: True, 2: False, 3: False}
    assert [r.doc_id for r in quality_rules.accepted(rows).collect()] == [1]


def test_odd_rows_and_empty_tables(odd_docs, no_docs):
    found = quality_rules.compression_bands(odd_docs)
    assert found.count() == 8
    assert found.where("doc_id is null").count() == 2
    assert quality_rules.compression_bands(no_docs).count() == 0
    assert quality_rules.accepted(odd_docs).columns == odd_docs.columns


def test_words_are_found_across_rows():
    import pyarrow as pa

    data, offsets = flat(pa.array(["a b", None, "", "c\x0bd é"]))
    with np.errstate(over="ignore"):
        words = Words(data, offsets)
    assert words.counts.tolist() == [2, 0, 0, 3]


def _share_right(scored, labels, column):
    rows = scored.join(labels.select("doc_id", column), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r[column] for r in rows)
    return right / len(rows), rows


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    scored = toxicity.score(docs, toxicity.train(docs, labels)).cache()
    share, rows = _share_right(scored, labels, "toxic")
    assert share > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored.collect())
    kept = toxicity.accepted(docs, toxicity.train(docs, labels))
    assert kept.count() == scored.where("predicted = 0").count()


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    vectors = quality_model.document_statistics(docs).cache()
    scored = quality_model.score(vectors, quality_model.train(vectors, labels)).cache()
    share, _ = _share_right(scored, labels, "quality")
    assert share > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored.collect())


def test_pairs_of_terms_are_learned():
    """Neither word alone decides, both together do."""
    draw = np.random.default_rng(5)
    x = draw.integers(0, 2, (2000, 6)).astype(np.uint8)
    y = (x[:, 0] & x[:, 1]).astype(float)
    bias, weights, vectors = toxicity._fit(x, y, 4, 800, 1e-5)
    model = toxicity.Model(np.zeros(1), bias, weights, vectors)
    rows, terms = np.nonzero(x)
    assert ((model.scores(rows, terms, len(x)) >= 0.5) == y).mean() > 0.98


def test_models_without_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([(1, None, None), (2, 7, 7)], "doc_id long, toxic int, quality int")
    assert all(r.score < 1e-200 for r in toxicity.score(odd_docs, toxicity.train(odd_docs, none)).collect())
    vectors = quality_model.document_statistics(odd_docs)
    assert {r.score for r in quality_model.score(vectors, quality_model.train(vectors, none)).collect()} == {0.0}
    assert toxicity.score(no_docs, toxicity.train(no_docs, none)).count() == 0
    assert quality_model.document_statistics(no_docs).count() == 0


def test_isotonic_levels():
    levels = quality_model.pool_adjacent_violators(np.array([0.1, 0.5, 0.3, 0.2, 0.9]), np.ones(5))
    assert np.allclose(levels, [0.1, 1 / 3, 1 / 3, 1 / 3, 0.9])


def test_terms_that_tell_in_pairs_only_are_found(spark):
    """Each of two words is as frequent under both labels; whether they come together decides."""
    draw = np.random.default_rng(4)
    fill = ["".join(draw.choice(list("bcdfghklmnprst"), 5)) for _ in range(300)]
    texts, rows = [], []
    for k in range(1200):
        both, first = draw.random() < 0.5, draw.random() < 0.5
        words = [*draw.choice(fill, 25), *(["zoqua", "vexil"] if both and first else [])]
        words += ["zoqua" if first else "vexil"] if not both else []
        texts.append((k, " ".join(draw.permutation(words))))
        rows.append((k, int(both)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    model = toxicity.train(docs, labels, n_terms=8)
    right, scored = _share_right(toxicity.score(docs, model), labels, "toxic")
    assert right > 0.97 and len(scored) > 150
    without = toxicity.train(docs, labels, n_terms=8, n_pair_terms=0)
    assert _share_right(toxicity.score(docs, without), labels, "toxic")[0] < 0.7


def test_scores_equal_a_double_loop_over_pairs():
    draw = np.random.default_rng(1)
    weights, vectors = draw.normal(size=30), draw.normal(size=(30, 4))
    model = toxicity.Model(np.zeros(0, np.int64), 0.3, weights, vectors)
    held = [np.sort(draw.choice(30, n, replace=False)) for n in (0, 1, 2, 7, 30)]
    rows = np.repeat(np.arange(len(held)), [len(h) for h in held])
    found = model.scores(rows, np.concatenate(held), len(held))
    for own, score in zip(held, found):
        z = 0.3 + weights[own].sum()
        z += sum(vectors[i] @ vectors[j] for k, i in enumerate(own) for j in own[k + 1 :])
        assert score == pytest.approx(1 / (1 + np.exp(-z)))


def test_verdicts_equal_judging_chunk_by_chunk(spark):
    import zstandard

    draw = np.random.default_rng(3)
    prose = lambda n: " ".join("".join(draw.choice(list("etaoinshrdlu"), draw.integers(2, 8))) for _ in range(n))
    noise = lambda n: "".join(map(chr, draw.integers(0x4E00, 0x9000, n)))
    texts = [prose(900), prose(5), "", prose(1800) + " " + noise(3000), prose(8000) + "drum and bass " * 900]
    texts += ["word " * 400, prose(3000)[:4096 + 100], prose(4000)[:4096 + 300] + noise(60), prose(90)]
    rules, packer = quality_rules.Bands(), zstandard.ZstdCompressor(level=3)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def outside(raw, bands):
        ratio = len(raw) / len(packer.compress(raw))
        low, high = next((low, high) for limit, low, high in bands if len(raw) <= limit)
        return not low <= ratio <= high

    for r in quality_rules.compression_bands(frame).collect():
        raw = texts[r.doc_id].encode()
        chunks = [raw[k : k + 4096] for k in range(0, len(raw), 4096)]
        if len(chunks) > 1 and len(chunks[-1]) < 512:
            chunks[-2:] = [chunks[-2] + chunks[-1]]
        chunks = [c for c in chunks if len(c) >= 512]
        bad = sum(outside(c, rules.chunk) for c in chunks)
        kept = bool(raw) and not outside(raw, rules.whole) and bad <= 0.1 * max(len(chunks), 1)
        counts = brute.rule_counts(texts[r.doc_id])
        assert (r.kept, r.n_chunks, r.low_chunks + r.high_chunks) == (kept and not counts[-1], len(chunks), bad), r.doc_id
    kept = {r.doc_id for r in quality_rules.compression_bands(frame).where("kept").collect()}
    assert 0 in kept and not kept & {1, 2, 3, 4, 5}
