"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are taken in blocks as they are scanned. A block's grid has a row for each distinct
term, in order of first appearance, and a column for each document; a point's weight is the
term's impact in the document. The grid is kept as a K2-treap (``k2treap``), beside the block's
terms, their document counts and the document ids. No block knows another, so the index is
built without a shuffle, and impacts need two numbers of the corpus only, summed beforehand.

An item is a set of weighted terms. In a block, each of its terms is a path of cells down its
row; all paths descend together over ranges of documents, the most promising ranges first. The
sum of the cells' maxima times the terms' weights bounds every score in the range from above, so
ranges below the k-th best score known to the task are left out, and the descent ends when none
is left. At the bottom the sums are the scores themselves: results are exact.

A task keeps the best k of each item over all its blocks; the tasks' lists are merged by rank.
Items are taken in chunks of bounded size, each a pass over the index.

Defined cases: null and empty texts have no terms; documents without a term count nowhere and are
not ranked; repeated rows are documents of their own; rows with a null id are ranked, behind
others of their score. Rows of one item id are one item with all their terms; a null id is an
item, too; items without terms have no results. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfit.llm.arrays import flat, slices
from starfit.llm.k2treap import K2Treap, pack, unpack
from starfit.llm.tables import scanned, staged

#: Bytes of text whose documents share a grid.
BLOCK_BYTES = 8 << 20
#: Ranges of documents that descend at once.
RANGES = 256
#: Bytes of items searched in one pass over the index.
ITEM_BYTES = 4 << 20

#: Bytes of terms: ASCII digits and letters, and everything beyond ASCII.
IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

INDEX = (
    "n_docs long, ids binary, null_ids binary, terms array<binary>, holding binary,"
    " height int, largest long, bits array<binary>, under array<binary>"
)


@dataclass(frozen=True)
class Weighting:
    """Impacts and term weights in whole numbers."""

    saturation: int = 8
    length_percent: int = 90

    def impacts(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // (1_000 * tf + self.saturation * m)

    def norms(self, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
        return 100 - self.length_percent + (self.length_percent * n * documents) // max(terms, 1)

    def weight(self, documents: int, holding: int) -> int:
        return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass(frozen=True)
class Index:
    """Blocks, and how many documents with a term and terms with repeats they hold."""

    blocks: DataFrame
    documents: int
    terms: int
    weighting: Weighting


def term_edges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of all terms of a batch of texts, and the bytes behind their last ones."""
    inside = IN_TERM[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start, last = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | first[1 : len(data)]
    last[:-1] &= ~inside[1:] | first[1 : len(data)]
    return np.flatnonzero(start), np.flatnonzero(last) + 1


def term_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The terms, lower-cased, as one binary array."""
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    packed = LOWER[data[IN_TERM[data]]]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(packed)]
    )


def corpus_counts(texts: DataFrame, text_column: str) -> tuple[int, int]:
    """Documents with a term, and terms with repeats."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(batch.column(0))
        documents = terms = 0
        for i, j in slices(offsets):
            starts, _ = term_edges(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            per_row = np.diff(np.searchsorted(starts, offsets[i : j + 1] - offsets[i]))
            documents += int((per_row > 0).sum())
            terms += len(starts)
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([terms])], names=["documents", "terms"])

    counted = scanned(texts.select(text_column), run, "documents long, terms long")
    found = counted.agg(F.sum("documents").alias("documents"), F.sum("terms").alias("terms")).first()
    return found.documents or 0, found.terms or 0


def build_index(
    docs: DataFrame, weighting: Weighting | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> Index:
    """Index every document; ``docs`` is read twice."""
    weighting = weighting or Weighting()
    documents, terms = corpus_counts(docs, text_column)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0)
        null_ids = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        data, offsets = flat(batch.column(1))
        for i, j in slices(offsets, BLOCK_BYTES):
            found = grid(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            if found is None:
                continue
            own, holding, treap, columns = found
            row = [len(columns), ids[i:j][columns].tobytes(), null_ids[i:j][columns].tobytes(), own, holding, *treap]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

    def grid(data: np.ndarray, offsets: np.ndarray):
        """Terms, their document counts, the treap, and the rows that have a term."""
        starts, ends = term_edges(data, offsets)
        if len(starts) == 0:
            return None
        coded = term_array(data, starts, ends).dictionary_encode()
        per_row = np.diff(np.searchsorted(starts, offsets))
        columns = np.flatnonzero(per_row)
        per_row = per_row[columns]
        width = len(coded.dictionary)
        key = np.repeat(np.arange(len(columns)), per_row) * width + coded.indices.to_numpy()
        key.sort()
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        tf = np.diff(np.append(heads, len(key)))
        column, row = np.divmod(key[heads], width)
        norms = weighting.norms(per_row, documents, terms)
        treap = K2Treap.build(row, column, weighting.impacts(tf, norms[column]))
        holding = pack(np.bincount(row, minlength=width))
        return coded.dictionary.cast(pa.binary()), holding, treap, columns

    names = [x.split()[0] for x in INDEX.split(", ")]
    many = pa.list_(pa.binary())
    kinds = [pa.int64(), pa.binary(), pa.binary(), many, pa.binary(), pa.int32(), pa.int64(), many, many]
    kinds = dict(zip(names, kinds)).values()
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_column)
    return Index(staged(scanned(rows, run, INDEX), "lexical-index"), documents, terms, weighting)


class Best:
    """The k best (score, id) so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = self.ids = np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)

    @property
    def least(self) -> int:
        """The score that a new one must reach."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (
            np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls))
        )
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


def descend(
    treap: K2Treap, rows: np.ndarray, weights: np.ndarray, best: Best, ids: np.ndarray, nulls: np.ndarray
) -> None:
    """Offer a block's documents to ``best``, most promising ranges of documents first.

    A batch on the heap holds ranges of one depth, and for each the cells of the item's rows:
    arrays of range number, term, cell and the cell's maximum.
    """
    n = len(rows)
    heap: list[tuple] = []
    tie = count()
    start = (np.zeros(1, np.int64), np.full(1, np.inf), np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int64))
    heapq.heappush(heap, (-math.inf, next(tie), 0, *start, np.full(n, treap.largest)))
    while heap:
        top, _, depth, first, bounds, own, term, cell, most = heapq.heappop(heap)
        if -top < best.least:
            return
        alive = bounds >= best.least
        if not alive.all():
            keep = alive[own]
            own, term, cell, most = (np.cumsum(alive) - 1)[own[keep]], term[keep], cell[keep], most[keep]
            first = first[alive]
        halves = []
        for right in (0, 1):
            there, cells, maxima = treap.step(depth, rows[term], cell, most, right)
            halves.append((2 * own[there] + right, term[there], cells, maxima))
        own, term, cell, most = (np.concatenate(x) for x in zip(*halves))
        bounds = np.bincount(own, weights[term] * most, minlength=2 * len(first))
        first = np.column_stack([2 * first, 2 * first + 1]).ravel()
        order = np.flatnonzero(bounds >= best.least)
        order = order[np.argsort(-bounds[order], kind="stable")]
        if depth + 1 == treap.height:
            at = first[order]
            best.add(bounds[order].astype(np.int64), ids[at], nulls[at])
            continue
        place = np.full(len(bounds), -1)
        place[order] = np.arange(len(order))
        own = place[own]
        live = own >= 0
        own, term, cell, most = own[live], term[live], cell[live], most[live]
        if len(order) > RANGES:
            by = np.argsort(own // RANGES, kind="stable")
            own, term, cell, most = own[by], term[by], cell[by], most[by]
        cuts = np.searchsorted(own // RANGES, np.arange(-(-len(order) // RANGES) + 1))
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            some = order[k * RANGES : (k + 1) * RANGES]
            batch = (first[some], bounds[some], own[a:b] - k * RANGES, term[a:b], cell[a:b], most[a:b])
            heapq.heappush(heap, (-float(bounds[some[0]]), next(tie), depth + 1, *batch))


def _item_terms(text: list[str | None]) -> list[bytes]:
    """Distinct terms of an item's texts, in order."""
    raw = pa.array([t or "" for t in text], pa.large_string())
    data, offsets = flat(raw)
    return term_array(data, *term_edges(data, offsets)).unique().to_pylist()


def _document_counts(index: Index, terms: list[bytes]) -> np.ndarray:
    """In how many documents each term occurs."""
    wanted = pa.array(terms, pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for own, holding in zip(batch.column(0), batch.column(1)):
                at = pc.index_in(wanted, own.values)
                here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                found[here] += unpack(holding.as_py())[at.drop_null().to_numpy()]
        here = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(found[here])], names=["term", "n"])

    partial = index.blocks.select("terms", "holding").mapInArrow(run, "term long, n long")
    out = np.zeros(len(terms), np.int64)
    for row in partial.groupBy("term").agg(F.sum("n").alias("n")).collect():  # the chunk's terms
        out[row.term] = row.n
    return out


def _search_chunk(index: Index, items: list[list[bytes]], k: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of the items, known by their places."""
    terms = sorted({t for own in items for t in own})
    place = {t: n for n, t in enumerate(terms)}
    holding = _document_counts(index, terms)
    weights = np.array([index.weighting.weight(index.documents, int(n)) for n in holding], np.float64)
    wanted, own_terms = pa.array(terms, pa.binary()), [np.array([place[t] for t in own], np.int64) for own in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in own_terms]
        for batch in batches:
            for n in range(batch.num_rows):
                block = {name: batch.column(c)[n] for c, name in enumerate(batch.schema.names)}
                ids = np.frombuffer(block["ids"].as_py(), np.int64)
                nulls = np.frombuffer(block["null_ids"].as_py(), bool)
                treap = K2Treap.load(*(block[c].as_py() for c in ("height", "largest", "bits", "under")))
                row = pc.fill_null(pc.index_in(wanted, block["terms"].values), -1).to_numpy()
                for own, kept in zip(own_terms, best):
                    here = own[(row[own] >= 0) & (weights[own] > 0)]
                    if len(here):
                        descend(treap, row[here].astype(np.int64), weights[here], kept, ids, nulls)
        item = np.repeat(np.arange(len(best)), [len(b.scores) for b in best])
        nulls = np.concatenate([b.nulls for b in best])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item),
                pa.array(np.concatenate([b.ids for b in best]), mask=nulls),
                pa.array(np.concatenate([b.scores for b in best])),
            ],
            names=["item", "doc_id", "score"],
        )

    blocks = index.blocks.drop("n_docs", "holding")
    return blocks.mapInArrow(run, "item long, doc_id long, score long")


def search(
    index: Index, items: DataFrame, k: int = 10, id_column: str = "item_id", text_column: str = "text"
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents of a score above 0."""
    spark = items.sparkSession
    rows = items.select(F.col(id_column).alias("item_id"), text_column)
    grouped = staged(rows.groupBy("item_id").agg(F.collect_list(text_column).alias("texts")), "items")
    n_bytes = grouped.agg(F.sum(F.octet_length(F.concat_ws(" ", "texts")))).first()[0] or 0
    kind = grouped.schema["item_id"].dataType.simpleString()
    chunks = -(-int(n_bytes) // ITEM_BYTES) or 1
    found = None
    for chunk in range(chunks):
        mine = grouped.where(F.pmod(F.xxhash64("item_id"), F.lit(chunks)) == chunk)
        here = mine.collect()  # some ITEM_BYTES of text
        terms = [_item_terms(r.texts) for r in here]
        if not any(terms):
            continue
        names = spark.createDataFrame([(n, r.item_id) for n, r in enumerate(here)], f"item long, item_id {kind}")
        part = _search_chunk(index, terms, k)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        kept = staged(ranked.where(F.col("rank") <= k), "ranked")
        part = kept.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found
