import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starfit.llm import quality_rules, vector_dedup, warc

PAGES = "page_id long, url string, html string, first string, key int"


@pytest.fixture(scope="module")
def pages(spark):
    body = "<html><body>" + "<p>text of the page</p>" * 40
    rows = [(k, f"http://host{k % 3}.example/{k}", f"{body}{k % 10}", "x", 1) for k in range(60)]
    rows += [(60, None, None, None, None), (61, "", "", None, 0), (62, "http://é x\n", "é" * 9000, None, 0)]
    return spark.createDataFrame(rows, PAGES)


def _expected(rows):
    payloads = {r.page_id: (r.html or "").encode() for r in rows}
    last: dict[bytes, int] = {}
    for i, p in payloads.items():
        last[p] = max(i, last.get(p, i))
    return {
        i: (len(p), brute.sha1(p), "response" if last[p] == i else "revisit", None if last[p] == i else last[p])
        for i, p in payloads.items()
    }


def _read(pages):
    found = warc.read_archives(warc.write_archives(pages, warc.archive_folder(pages))).collect()
    return [(r.page_id, (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in found]


def test_archives_come_back(pages):
    found = _read(pages)
    assert dict(found) == _expected(pages.collect()) and len(found) == 63


def test_archive_files(pages):
    import zstandard

    archives = warc.write_archives(pages, warc.archive_folder(pages)).collect()
    assert sum(a.records for a in archives) == 63
    for a in archives:
        with open(a.path.removeprefix("file://"), "rb") as file:
            content = file.read()
        size = int.from_bytes(content[4:8], "little")
        assert content[:4] == (0x184D2A5D).to_bytes(4, "little") and size > 0
        # Each record is a frame of its own.
        known, frames, n = zstandard.ZstdCompressionDict(content[8 : 8 + size]), content[8 + size :], 0
        while frames:
            part = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
            assert part.decompress(frames).startswith(warc.VERSION)
            frames, n = part.unused_data, n + 1
        assert n == a.records


def test_archives_of_odd_pages(spark, pages):
    rows = [(1, "u", "a", None, None)] * 2 + [(None, "u", "a", None, None), (None, "u", "b", None, None)]
    found = _read(spark.createDataFrame(rows, PAGES))
    kinds = sorted(((i, kind, to) for i, (_, _, kind, to) in found), key=str)
    assert kinds == sorted(
        [(1, "response", None), (1, "response", None), (None, "revisit", 1), (None, "response", None)], key=str
    )
    assert _read(pages.where("page_id < 0")) == []


def test_small_payloads_are_all_responses(pages):
    found = warc.read_archives(warc.write_archives(pages, warc.archive_folder(pages), min_payload=10**6))
    assert found.where("record_type <> 'response'").count() == 0


def _vectors(seed=3):
    draw = np.random.default_rng(seed)
    rows = []
    for k in range(400):
        rows.append((draw.normal(size=16), k % 3))
    for k in range(0, 60):  # near copies, chains and exact copies
        base = rows[k % 12][0]
        rows.append((base * draw.uniform(0.5, 2) + (k % 4) * 0.03 * draw.normal(size=16), rows[k % 12][1]))
    return [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)]


def _links(rows, least=0.98):
    x = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: k for i, _, k in rows}
    near = {i: [j for j in x if j != i and label[i] == label[j] and float(x[i] @ x[j]) >= least] for i in x}
    root = {i: i for i in x}
    changed = True
    while changed:
        changed = False
        for i in x:
            low = min([root[i], *(root[j] for j in near[i])])
            if low < root[i]:
                root[i], changed = low, True
    return {i: (len(near[i]), root[i], root[i] == i) for i in x}


@pytest.mark.parametrize(("cluster", "room"), [(500, 2000), (20, 2000), (40, 10)])
def test_links_equal_brute_force(spark, monkeypatch, cluster, room):
    monkeypatch.setattr(vector_dedup, "CLUSTER", cluster)
    monkeypatch.setattr(vector_dedup, "ROOM", room)
    rows = _vectors()
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, point string")
    result = vector_dedup.near_duplicates(vectors).cache()
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in result.collect()}
    expected = _links(rows)
    total = sum(n for n, *_ in expected.values())
    assert set(found) == set(expected)
    assert all(found[i][0] <= expected[i][0] for i in found)
    assert sum(n for n, *_ in found.values()) >= 0.95 * total
    if cluster == 500:
        assert found == expected
    monkeypatch.setattr(vector_dedup, "AUDITED", 40)
    audited = vector_dedup.audit(vectors, result, divisor=5).first()
    assert audited.recall >= 0.9 and audited.links > 0


def _groups(sizes, dim=64, noise=0.05, seed=5):
    """Near copies around one random vector a group, none equal to another."""
    draw = np.random.default_rng(seed)
    x = np.concatenate([draw.normal(size=dim) + noise * draw.normal(size=(n, dim)) for n in sizes])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


@pytest.mark.parametrize("sizes", [[75] * 20, [70] * 40, [70, 1000, 90, 150, 300, 70, 500]])
def test_searches_leave_groups_of_near_copies(sizes):
    x = _groups(sizes)
    graph, entries = vector_dedup.robust_prune(x), vector_dedup.medoid_and_spread(x)
    found = vector_dedup.range_search(x, graph, np.arange(len(x)), entries, 0.98)
    true = (x @ x.T >= 0.98).sum(1)
    assert sum(map(len, found)) >= 0.99 * true.sum()


def test_many_groups_of_near_copies_within_a_label(spark):
    x = _groups([70] * 12 + [75] * 12 + [120] * 5 + [300, 1000])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    result = vector_dedup.near_duplicates(vectors)
    found = {r.vec_id: (r.n_links, r.component_id) for r in result.collect()}
    close = x @ x.T >= 0.98
    true, first = close.sum(1) - 1, close.argmax(1)
    assert sum(n for n, _ in found.values()) >= 0.99 * true.sum()
    assert all(n <= true[i] for i, (n, _) in found.items())
    assert [found[i][1] for i in range(len(x))] == first.tolist()


def test_pairs_found_from_one_end_count_for_both(spark, monkeypatch):
    """Each point joins one cluster but for one group's, so that pairs are met from one side only."""
    x = _groups([40, 40], dim=8, noise=0.1)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    deal = vector_dedup._deal

    def lopsided(points, n_points):
        few = F.pmod(F.xxhash64("point"), F.lit(2)) == 0
        home = F.when(few, 0).otherwise(1).cast("long")
        clusters = F.when(few, F.array(home, F.lit(1).cast("long"))).otherwise(F.array(home))
        names = [c for c in deal(points, n_points).columns if c not in ("cluster", "home", "clusters")]
        dealt = points.select(*names, clusters.alias("clusters"), home.alias("own"))
        dealt = dealt.withColumn("cluster", F.explode("clusters")).withColumn("home", F.col("cluster") == F.col("own"))
        return dealt.drop("own")

    monkeypatch.setattr(vector_dedup, "_deal", lopsided)
    found = {r.vec_id: r.n_links for r in vector_dedup.near_duplicates(vectors, 0.9).collect()}
    true = (x @ x.T >= 0.9).sum(1) - 1
    assert [found[i] for i in range(len(x))] == true.tolist()


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [2.0, 0.0], 2), (4, [2.0, 0.0], None), (5, None, 1),
        (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1),
        (11, [1.0, 0.0, 0.0], 1), (12, [1e300, 0.0], 1), (None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in vector_dedup.near_duplicates(vectors).collect()), key=str)
    linked = [(1, 4, 1), (1, 4, 1), (2, 4, 1), (12, 4, 1), (None, 4, 1)]
    alone = [(k, 0, k) for k in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    assert found == sorted([*linked, *alone], key=str)
    assert vector_dedup.near_duplicates(vectors.where("vec_id < 0")).count() == 0


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    columns = docs.columns
    kept = stages["quality rules"](spark, docs, sf_dir).cache()
    passed = quality_rules.compression_bands(docs).where("kept").select("doc_id")
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in passed.collect()}
    clean = stages["toxicity"](spark, kept, sf_dir).cache()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert clean.join(labels.where("toxic = 1"), "doc_id").count() <= 1
    one = stages["n-gram Jaccard join"](spark, clean, sf_dir).cache()
    groups = brute.jaccard_components({r.doc_id: r.text for r in clean.collect()})
    assert sorted(r.doc_id for r in one.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)
    cut = stages["suffix-array dedup"](spark, one, sf_dir).cache()
    assert kept.columns == clean.columns == one.columns == cut.columns == columns
    expected = brute.without_repeats({r.doc_id: r.text for r in one.collect()})
    sizes = {r.doc_id: r.n for r in cut.select("doc_id", F.octet_length("text").alias("n")).collect()}
    # Characters that lost a byte go as a whole.
    assert all(0 <= expected[i][0] - expected[i][1] - n <= 6 * expected[i][2] for i, n in sizes.items())
    assert cut.where("n_chars <> length(text)").count() == 0
    pieces = stages["best-fit packing"](spark, cut, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == set(sizes)
    assert corpus_pipeline.run(spark, sf_dir).count() == pieces.count()
