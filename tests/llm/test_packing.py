import base64
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers as public
import pytest
import regex

from starfit.llm import byte_bpe, packing, sharding
from starfit.llm.pieces import RankEncoder, plain_ranks
from starfit.llm.queries import packed


def test_shards_keep_groups_and_are_even(docs, texts):
    rows = sharding.shard_documents(docs, 5).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    shards: dict[int, list[int]] = {}
    group: dict[str | None, set[int]] = {}
    sizes = dict.fromkeys(range(5), 0)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        shards.setdefault(r.shard, []).append(r.slot)
        group.setdefault(texts[r.doc_id], set()).add(r.shard)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert all(len(s) == 1 for s in group.values())
    bytes_of: dict = {}
    for r in rows:
        bytes_of[texts[r.doc_id]] = bytes_of.get(texts[r.doc_id], 0) + r.size
    assert max(sizes.values()) - min(sizes.values()) <= max(bytes_of.values())
    loads = [0] * 5  # largest group first, to the least loaded shard
    for size in sorted(bytes_of.values(), reverse=True):
        loads[loads.index(min(loads))] += size
    assert sorted(sizes.values()) == sorted(loads)


def test_schedule_is_the_heap_rule():
    """The same loads as giving every group, largest first, to the least loaded shard."""
    draw = np.random.default_rng(1)
    sizes = np.sort(draw.choice(np.arange(1, 500), 60, replace=False))[::-1]
    counts = draw.integers(1, 400, 60)
    loads = [0] * 7
    for size, count in zip(sizes, counts):
        for _ in range(count):
            k = loads.index(min(loads))
            loads[k] += int(size)
    dealt = sharding.schedule(sizes, counts, 7)
    assert [int(sum(g[k] * s for g, s in zip(dealt, sizes))) for k in range(7)] == loads
    assert [int(g.sum()) for g in dealt] == counts.tolist()


def test_sharding_odd_rows(odd_docs, no_docs):
    rows = sharding.shard_documents(odd_docs, 3).collect()
    assert len(rows) == 8
    assert len({r.shard for r in rows if r.size > 8 and r.text_crc32 == rows[0].text_crc32}) <= 1
    assert sharding.shard_documents(no_docs).count() == 0


def _check_packing(rows, ids, capacity):
    sequences: dict[int, list] = {}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_documents(docs, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    ids = {
        i: np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in texts.items()
    }
    rows = packed(docs).collect()
    used = _check_packing(rows, ids, 2048)
    total = sum(map(len, ids.values()))
    assert sum(r.length for r in rows) == total
    assert used <= -(-total // 2048) + 1
    pieces: dict[int, list] = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for i, own in pieces.items():
        own.sort()
        assert [p for p, *_ in own] == list(range(len(own)))
        assert all(length == 2048 for _, _, length in own[1:])
        assert sum(length for *_, length in own) == len(ids[i])
        assert len(own) == 1 or own[0][2] == (len(ids[i]) % 2048 or 2048)


def test_packing_odd_rows(odd_docs, no_docs):
    rows = packed(odd_docs).collect()
    assert len(rows) == 8 and {r.length for r in rows if r.doc_id == 4} == {1}
    assert packed(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_bin_completion_beats_best_fit(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.integers(20, 70, 60)
    counts = np.bincount(lengths, minlength=101)
    first, found = packing.best_fit_decreasing(counts, 100), packing.pack_lengths(counts, 100)
    for fillings in (first, found):
        used = np.zeros(101, int)
        for filling, times in fillings:
            assert sum(filling) <= 100 and times > 0
            np.add.at(used, list(filling), times)
        assert (used == counts).all()
    assert sum(n for _, n in found) <= sum(n for _, n in first)
    assert sum(n for _, n in found) >= packing.lower_bound(counts, 100)


@pytest.mark.parametrize("seed", range(8))
def test_incumbent_is_best_fit_decreasing(seed):
    """The same rooms as giving every piece, longest first, to the sequence with the least room for it."""
    draw = np.random.default_rng(seed)
    lengths = np.sort(draw.integers(1, 60, 300))[::-1]
    rooms: list[int] = []
    for x in lengths.tolist():
        k = min((k for k, room in enumerate(rooms) if room >= x), key=rooms.__getitem__, default=None)
        if k is None:
            rooms.append(100 - x)
        else:
            rooms[k] -= x
    fillings = packing.best_fit_decreasing(np.bincount(lengths, minlength=101), 100)
    assert sorted(r for f, n in fillings for r in [100 - sum(f)] * n) == sorted(rooms)
    used = sorted((x for f, n in fillings for x in f * n), reverse=True)
    assert used == lengths.tolist()


def test_bin_completion_finds_the_optimum():
    """Triples that fill 100 exactly, where taking the longest that fits goes wrong."""
    counts = np.zeros(101, int)
    for a, b, c in [(51, 27, 22), (50, 28, 22), (48, 30, 22), (47, 27, 26), (46, 29, 25)] * 4:
        counts[[a, b, c]] += 1
    counts = np.bincount(np.repeat(np.arange(101), counts), minlength=101)
    total = int((counts * np.arange(101)).sum())
    found = sum(n for _, n in packing.pack_lengths(counts, 100))
    assert found <= sum(n for _, n in packing.best_fit_decreasing(counts, 100))
    assert found == -(-total // 100)


def test_pieces_alone_have_the_ids_of_the_whole_text(texts):
    """The vocabulary file read by tokenizers encodes a pre-token alike alone and in its text."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    find = regex.compile(public.PATTERN).findall
    for text in [*filter(None, texts.values()), "it's we'll 'tis\n\n  x <|endoftext|> 12ab  \t", " lead", "trail \n"]:
        parts = [i for p in find(text) for i in model.encode(p, add_special_tokens=False).ids]
        assert parts == model.encode(text, add_special_tokens=False).ids


def _expected(text):
    import tiktoken

    ranks = byte_bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))
    coder = tiktoken.Encoding("t", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def digests(text):
        ids = coder.encode_ordinary(text or "")
        said = " ".join(map(str, ids)).encode()
        return len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    return {i: digests(t) for i, t in text.items()}


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 1_024), (64, 24), (37, 17)])
def test_encoding_equals_the_library(docs, texts, chunk, overlap):
    vocabulary = byte_bpe.Vocabulary.read(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    rows = byte_bpe.encode_documents(docs, vocabulary, chunk=chunk, overlap=overlap).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == _expected(texts)
    assert len(rows) == len(texts)


def test_chunks_meet_at_awkward_places(spark):
    draw = np.random.default_rng(8)
    parts = ["'s", "'re", "'ll", " ", "  ", "\n", "\n\n", "abc", " don", "12", " 345", "!!", " ?!", "é", "漢字", "\t"]
    rows = {i: "".join(draw.choice(parts, draw.integers(1, 200))) for i in range(60)}
    rows[60], rows[61], rows[62] = " " * 300, "x" * 300, "\n" * 100 + "y" * 100 + " " * 100
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    vocabulary = byte_bpe.Vocabulary.read(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    found = byte_bpe.encode_documents(docs, vocabulary, chunk=40, overlap=20).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == _expected(rows)


def test_encoding_odd_rows(odd_docs, no_docs):
    vocabulary = byte_bpe.Vocabulary.read(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    for chunk in (32_768, 50):
        rows = byte_bpe.encode_documents(odd_docs, vocabulary, chunk=chunk, overlap=30).collect()
        assert len(rows) == 8 and sum(r.doc_id is None for r in rows) == 2
    assert byte_bpe.encode_documents(no_docs, vocabulary).count() == 0


def test_ranks_file_is_read():
    ranks = byte_bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        token, rank = next(lines).split()
    assert ranks[base64.b64decode(token)] == int(rank)


def test_plain_rank_order_is_told_from_other_files():
    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        content = file.read()
    ranks = plain_ranks(content)
    assert len(ranks) == len(set(ranks.values())) and set(range(256)) <= {t[0] for t in ranks if len(t) == 1}
    model = json.loads(content)
    model["model"]["merges"] = model["model"]["merges"][:3]
    model["model"]["merges"].reverse()
    assert plain_ranks(json.dumps(model)) is None
    assert plain_ranks(json.dumps(json.loads(content) | {"normalizer": {"type": "Lowercase"}})) is None


def test_rank_ids_equal_the_files_library(spark):
    from tokenizers import Tokenizer

    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        content = file.read()
    library = Tokenizer.from_str(content)
    library.encode_special_tokens = True
    encoder = RankEncoder(plain_ranks(content), public.PATTERN)
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    texts = [r.text or "" for r in rows] + ["<|endoftext|> x", "a" * 300_000, " " * 300_000 + "b"]
    found = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [encoder.text(t) for t in texts] == [np.array(x.ids, "<u4").tobytes() for x in found]


def test_stitching_a_long_run_searches_it_once():
    calls: list[int] = []
    find = regex.compile(public.PATTERN)

    class Counted:
        def findall(self, text):
            calls.append(len(text))
            return find.findall(text)

    text = "some words " * 40 + "a" * 60_000 + " and more" * 40
    size, overlap = 1_000, 100
    chunks = [text[i : i + size + overlap] for i in range(0, len(text), size)]
    segments = byte_bpe.stitch(Counted(), chunks, [byte_bpe.cuts(find, c) for c in chunks], size)
    pieces = [p for part, ends in segments for p in byte_bpe.parted(part, ends.tolist())]
    assert pieces == find.findall(text)
    assert sum(calls) < 2 * len(text)
