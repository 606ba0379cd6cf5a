"""Removal of repeated passages by prefix-free parsing.

A byte is removed if some ``LENGTH`` bytes around it also start in a document with a smaller id.
Sorting all suffixes of a corpus would find these, but it moves every position of every text.
Here, as in prefix-free parsing, a hash picks trigger positions that depend on the bytes alone, and
triggers part each text into overlapping phrases. No suffix array, dictionary order or parse order is
made: the result only asks which windows are equal, so phrases and windows are grouped by hash.

Triggers are the smallest hashes among the ``TRIGGER``-byte strings of a window of ``LENGTH``
bytes, so every window holds a trigger, its first smallest, and belongs to that trigger's phrase
alone: a phrase is a run of windows with one trigger. Two steps then compare all windows.

*Parse.* Phrases are packed by a hash of their trigger. A phrase that occurs as a whole in a
smaller document is removed there. Within a block of texts this is settled at once, and only a
phrase's first document goes on, so that no number of copies meets in one task.

*Dictionary.* What is left are phrases that differ and yet may share some windows: their trigger
and the bytes on one side of it must agree, for a shared window reaches at least half of what is
not trigger to one side. Only these phrases' windows are grouped by the hash of their content, and each
window's smallest document decides.

Neighbouring phrases of one content, which a periodic text is made of, are one entry with a count.
Strings are compared by 64-bit hashes (the parse by trigger and phrase together). Everything is
judged on the input texts; matches never cross documents.

Defined cases: null and empty texts have no bytes; texts shorter than ``LENGTH`` are kept whole;
rows that repeat an id are not smaller than each other, so repeated rows are judged alike, whether
their texts are equal or not; a row with a null id is kept whole and removes nothing elsewhere;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfit.llm.arrays import Prefix, flat, mix, slices
from starfit.llm.tables import grouped, partitions, scanned, staged

LENGTH = 50
TRIGGER = 20
BLOCK_BYTES = 4 << 20
#: A span of bytes in one number: start * SPAN + size, sizes being under SPAN. A span that comes
#: several times, at even distances, has ``again``: times * SPAN + distance; 0 for one time.
SPAN = 256
FOUND = "doc_id long, alt int, open boolean, span long, again long"
PACKED = (
    "bucket long, first binary, second binary, sides binary, docs binary, alts binary, spans binary, agains binary"
)
#: Bytes of packed phrases that meet in one group, and their bytes by byte of text, at most.
GROUP_BYTES = 16 << 20
PHRASE_BYTES = 3


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, by first neighbour."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


class Phrases:
    """Phrases of a slice: row, first window (``lo``), windows, trigger, content and sides."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.lo = self.rows = self.windows = np.zeros(0, np.int64)
        self.trigger = self.content = np.zeros(0, np.uint64)
        self.sides = np.zeros((0, 2), np.uint32)
        if len(data) < LENGTH:
            return
        prefix = Prefix(data)
        grams = mix(prefix.every(TRIGGER))
        # Hash above, place below: the smallest is the leftmost of the smallest hashes.
        placed = grams >> np.uint64(32) << np.uint64(32) | np.arange(len(grams), dtype=np.uint64)
        trigger = (window_minima(placed, LENGTH - TRIGGER + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ends = np.repeat(offsets[1:], np.diff(offsets))[: len(trigger)]
        starts = np.flatnonzero(np.arange(len(trigger)) + LENGTH <= ends)
        if len(starts) == 0:
            return
        at = trigger[starts]
        head = np.append(True, (starts[1:] != starts[:-1] + 1) | (at[1:] != at[:-1]))
        first = np.flatnonzero(head)
        self.lo, at = starts[first], at[first]
        self.windows = np.diff(np.append(first, len(starts)))
        self.rows = np.searchsorted(offsets, self.lo, "right") - 1
        end = self.lo + self.windows + LENGTH - 1
        self.trigger = grams[at]
        shape = ((at - self.lo) << 8 | self.windows).astype(np.uint64)
        self.content = mix(prefix.of(self.lo, end) + mix(shape))
        half = (LENGTH - TRIGGER) // 2
        left = mix(prefix.of(np.maximum(at - half, 0), at + TRIGGER))
        right = mix(prefix.of(at, np.minimum(at + TRIGGER + half, len(data))))
        # 0 where no window of the phrase reaches so far.
        left = np.where(at - self.lo >= half, left >> np.uint64(48) | np.uint64(1), 0)
        right = np.where(end - at - TRIGGER >= half, right >> np.uint64(48) | np.uint64(1), 0)
        self.sides = np.column_stack([left, right]).astype(np.uint16)
        self.lo = self.lo - offsets[self.rows]


def planes(values: np.ndarray) -> bytes:
    """Integers with equal bytes put together, which compresses their high bytes away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(raw: list[bytes], kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(width, -1).T).view(kind).ravel() for x in raw]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def first_docs(keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by keys, then document: the order, the group of each sorted row, each group's first document."""
    order = np.lexsort((docs, *keys[::-1]))
    head = np.zeros(len(order), bool)
    head[:1] = True
    for key in keys:
        head[1:] |= key[order[1:]] != key[order[:-1]]
    return order, np.cumsum(head) - 1, docs[order[head]]


def pack(
    bucket: np.ndarray, columns: list[np.ndarray], passing: list[np.ndarray], buckets: int
) -> Iterator[pa.RecordBatch]:
    """One row per bucket. ``passing`` (docs, alts, spans, agains) is settled and goes to buckets
    from ``buckets`` on."""
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.append(np.diff(bucket[order]) != 0, True)) + 1 if len(order) else np.zeros(0, np.int64)
    names: list[int] = []
    rows: list[list[bytes]] = []
    for a, b in zip(np.append(0, ends[:-1]), ends):
        at = order[a:b]
        names.append(int(bucket[at[0]]))
        rows.append([planes(c[at]) for c in columns])
    if len(passing[0]):
        names.append(buckets + int(passing[2].sum() % buckets))
        rows.append([b"", b"", b"", *(planes(c) for c in passing)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), *(pa.array(c, pa.binary()) for c in (zip(*rows) if rows else [()] * 7))],
        names=[x.split()[0] for x in PACKED.split(", ")],
    )


def _found(docs: np.ndarray, alts: np.ndarray, open_: np.ndarray, spans: np.ndarray, agains: np.ndarray) -> pa.Table:
    return pa.table({"doc_id": docs, "alt": alts, "open": open_, "span": spans, "again": agains})


def _settled(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents, alts, spans and agains of packed rows."""
    kinds = {"docs": np.int64, "alts": np.int32, "spans": np.int64, "agains": np.int64}
    return tuple(from_planes(table[c].to_pylist(), k) for c, k in kinds.items())


def runs(rows: np.ndarray, content: np.ndarray, lo: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring phrases of one content, as in a periodic text: each run's first, and ``again``."""
    same = (rows[1:] == rows[:-1]) & (content[1:] == content[:-1]) & (lo[1:] == lo[:-1] + windows[:-1])
    first = np.flatnonzero(np.append(len(rows) > 0, ~same)[: len(rows)])
    times = np.diff(np.append(first, len(rows)))
    return first, np.where(times > 1, times * SPAN + windows[first], 0)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Bytes, offsets, ids, alts of blocks of a batch (doc_id, alt, text, ...), and its first row."""
    data, offsets = flat(batch.column(2))
    ids, alts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    for i, j in slices(offsets, BLOCK_BYTES):
        yield data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ids[i:j], alts[i:j], i


def _parsed(docs: DataFrame, buckets: int) -> DataFrame:
    def parse(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for data, offsets, ids, alts, _ in _blocks(batch):
            found: list[Phrases] = []
            rows: list[np.ndarray] = []
            for a, b in slices(offsets):
                with np.errstate(over="ignore"):
                    found.append(Phrases(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                rows.append(found[-1].rows + a)
            trigger, content, windows, lo = (
                np.concatenate([getattr(x, c) for x in found]) for c in ("trigger", "content", "windows", "lo")
            )
            sides, row = np.concatenate([x.sides for x in found]), np.concatenate(rows)
            first, again = runs(row, content, lo, windows)
            trigger, content, windows, lo, sides, row = (x[first] for x in (trigger, content, windows, lo, sides, row))
            doc, alt = ids[row], alts[row].astype(np.int32)
            span = lo * SPAN + windows + LENGTH - 1
            # Copies within the block: only the first document's phrases go on.
            order, group, first = first_docs([content], doc)
            late = np.zeros(len(doc), bool)
            late[order] = doc[order] > first[group]
            go = ~late
            bucket = ((trigger[go] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            own_sides = sides[go].copy().view(np.uint32).ravel()
            columns = [trigger[go].astype(np.uint32), content[go], own_sides, doc[go], alt[go], span[go], again[go]]
            yield from pack(bucket, columns, [doc[late], alt[late], span[late], again[late]], buckets)

    return scanned(docs.select("doc_id", "alt", "text"), parse, PACKED)


def _phrase_matches(packed: DataFrame, buckets: int) -> DataFrame:
    """Spans that are whole phrases of smaller documents, and open ones that may share windows."""

    def match(key, table):
        doc, alt, span, again = _settled(table)
        if key[0].as_py() >= buckets:
            return _found(doc, alt, np.zeros(len(doc), bool), span, again)
        trigger = from_planes(table["first"].to_pylist(), np.uint32)
        content = from_planes(table["second"].to_pylist(), np.uint64)
        sides = from_planes(table["sides"].to_pylist(), np.uint32)
        order, group, first = first_docs([trigger, content], doc)
        whole = doc[order] > first[group]
        one = order[np.flatnonzero(np.append(True, np.diff(group) != 0))]  # one phrase of each content
        shares = np.zeros(len(one), bool)
        for side in (sides & np.uint32(0xFFFF), sides >> np.uint32(16)):
            o, g, smallest = first_docs([trigger[one], side[one]], first)
            largest = np.zeros(len(smallest), np.int64)
            largest[g] = first[o]  # sorted by document: the last one written is the largest
            shares[o] |= (largest[g] != smallest[g]) & (side[one][o] != 0)
        open_ = ~whole & shares[group]
        say = whole | open_
        at = order[say]
        return _found(doc[at], alt[at], open_[say], span[at], again[at])

    return grouped(packed, ["bucket"], match, FOUND)


def _windows_parsed(docs: DataFrame, buckets: int) -> DataFrame:
    """Windows of the open spans of (doc_id, alt, text, spans), packed by content."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for data, offsets, ids, alts, i in _blocks(batch):
            row, own, again = _listed(batch, i, i + len(ids))
            count = own % SPAN - LENGTH + 1
            row, again = np.repeat(row, count), np.repeat(again, count)
            lo = np.repeat(own // SPAN - (np.cumsum(count) - count), count) + np.arange(count.sum())
            content = np.zeros(len(lo), np.uint64)
            for a, b in slices(offsets):
                at = np.flatnonzero((row >= a) & (row < b))
                with np.errstate(over="ignore"):
                    starts = lo[at] + offsets[row[at]] - offsets[a]
                    content[at] = mix(Prefix(data[offsets[a] : offsets[b]]).of(starts, starts + LENGTH))
            doc, alt, span = ids[row], alts[row].astype(np.int32), lo * SPAN + LENGTH
            order, group, first = first_docs([content], doc)
            late = np.zeros(len(doc), bool)
            late[order] = doc[order] > first[group]
            go = ~late
            bucket = ((content[go] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            none = np.zeros(go.sum(), np.uint8)
            columns = [content[go], none, none, doc[go], alt[go], span[go], again[go]]
            yield from pack(bucket, columns, [doc[late], alt[late], span[late], again[late]], buckets)

    return scanned(docs.select("doc_id", "alt", "text", "spans", "runs"), cut, PACKED)


def _window_matches(packed: DataFrame, buckets: int) -> DataFrame:
    """Windows that smaller documents hold, too."""

    def match(key, table):
        doc, alt, span, again = _settled(table)
        if key[0].as_py() < buckets:
            order, group, first = first_docs([from_planes(table["first"].to_pylist(), np.uint64)], doc)
            late = order[doc[order] > first[group]]
            doc, alt, span, again = doc[late], alt[late], span[late], again[late]
        return _found(doc, alt, np.zeros(len(doc), bool), span, again)

    return grouped(packed, ["bucket"], match, FOUND)


def _spans(found: DataFrame) -> DataFrame:
    """Lists by document: spans, and those that come several times."""
    once = F.col("again") == 0
    return found.groupBy("doc_id", "alt").agg(
        F.collect_list(F.when(once, F.col("span"))).alias("spans"),
        F.collect_list(F.when(~once, F.struct("span", "again"))).alias("runs"),
    )


def _listed(batch: pa.RecordBatch, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row (from 0), span and again of everything that columns 3 and 4 list in some rows."""
    spans, several = batch.column(3), batch.column(4)
    ends = spans.offsets.to_numpy()[i : j + 1], several.offsets.to_numpy()[i : j + 1]
    row = np.concatenate([np.repeat(np.arange(j - i), np.diff(e)) for e in ends])
    one = spans.values.to_numpy(zero_copy_only=False)[ends[0][0] : ends[0][-1]]
    more = [several.values.field(k).to_numpy(zero_copy_only=False)[ends[1][0] : ends[1][-1]] for k in (0, 1)]
    return row, np.concatenate([one, more[0]]), np.concatenate([np.zeros(len(one), np.int64), more[1]])


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes left) of every document.

    ``carried`` is a struct of the columns named in ``carry``.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.struct(*(carry or [id_column])).alias("carried"),
    ).withColumn("text_key", F.xxhash64("text"))
    # Texts that share an id are told apart by a number, nearly always 0.
    shared = (
        rows.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("text_key").alias("least"), F.max("text_key").alias("most"))
        .where("least <> most")
        .select("doc_id")
    )
    alike = staged(rows.select("doc_id", "text_key").join(shared, "doc_id", "left_semi").distinct(), "alike")
    if alike.limit(1).count():
        by_id = Window.partitionBy("doc_id").orderBy("text_key")
        # Null ids never join and keep number 0.
        rows = rows.join(
            alike.withColumn("alt", F.row_number().over(by_id).cast("int")), ["doc_id", "text_key"], "left"
        ).withColumn("alt", F.coalesce("alt", F.lit(0)))
    else:
        rows = rows.withColumn("alt", F.lit(0))
    known = rows.where("doc_id is not null")
    n_bytes = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(docs.sparkSession), -(-n_bytes * PHRASE_BYTES // GROUP_BYTES))

    found = staged(_phrase_matches(_parsed(known, buckets), buckets), "phrases")
    open_ = _spans(found.where("open"))
    windows = _windows_parsed(known.join(open_, ["doc_id", "alt"]), buckets)
    narrowed = staged(_window_matches(windows, buckets), "windows")
    removed = _spans(found.where("not open").unionByName(narrowed))

    def remove(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(batch.column(2))
        for i, j in slices(offsets):
            size = offsets[j] - offsets[i]
            row, own, again = _listed(batch, i, j)
            at = offsets[i:j][row] - offsets[i] + own // SPAN
            times = np.maximum(again // SPAN, 1)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at, own = np.repeat(at, times) + nth * np.repeat(again % SPAN, times), np.repeat(own, times)
            change = np.zeros(size + 1, np.int32)
            np.add.at(change, at, 1)
            np.subtract.at(change, at + own % SPAN, 1)
            gone = np.cumsum(change)[:size] > 0
            start = gone.copy()
            start[1:] &= ~gone[:-1]
            edges = offsets[i:j][offsets[i:j] < offsets[j]] - offsets[i]
            start[edges] = gone[edges]  # a run ends where its document does
            sums = np.append(0, np.cumsum(gone))
            begun = np.append(0, np.cumsum(start))
            a, b = offsets[i:j] - offsets[i], offsets[i + 1 : j + 1] - offsets[i]
            left = b - a - (sums[b] - sums[a])
            kept = data[offsets[i] : offsets[j]][~gone]
            ends = np.append(0, np.cumsum(left)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, j - i),
                    batch.column(1).slice(i, j - i),
                    pa.array(b - a),
                    pa.array(sums[b] - sums[a]),
                    pa.array(begun[b] - begun[a]),
                    pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(kept)]),
                ],
                names=["doc_id", "carried", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    joined = rows.join(removed, ["doc_id", "alt"], "left").select(
        "doc_id",
        "carried",
        "text",
        F.coalesce("spans", F.array().cast("array<long>")).alias("spans"),
        F.coalesce("runs", F.array().cast("array<struct<span:long,again:long>>")).alias("runs"),
    )
    counts = "n_bytes long, n_removed long, n_spans long, kept binary"
    return scanned(joined, remove, f"doc_id long, carried {joined.schema['carried'].dataType.simpleString()}, {counts}")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows of ``docs`` with their other columns and what is left of their texts.

    A character that lost some of its bytes goes. Null texts stay null.
    """
    rest = [c for c in docs.columns if c != text_column]
    null = "_null" + "_" * max(map(len, docs.columns), default=0)  # no column's name
    found = remove_repeats(docs.withColumn(null, F.col(text_column).isNull()), id_column, text_column, [*rest, null])

    def decode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [x.decode("utf-8", "ignore") for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["carried", "text"])

    kind = found.schema["carried"].dataType.simpleString()
    texts = scanned(found.select("carried", "kept"), decode, f"carried {kind}, text string")
    text = F.when(~F.col(f"carried.{null}"), F.col("text")).alias(text_column)
    return texts.select(*(text if c == text_column else F.col(f"carried.`{c}`").alias(c) for c in docs.columns))
