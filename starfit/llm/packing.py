"""Best-fit packing of token sequences by bin completion with branch and bound.

Only lengths matter to a packing, and there are at most ``capacity`` of them, so the search runs
over a histogram: how many pieces have each length. A filling of one sequence is a set of
lengths; wherever it is chosen it is laid down as often as the counts allow, so the search is as
long for a billion pieces as for a thousand.

Bin completion takes the longest piece left and enumerates the undominated fillings around it,
fullest first: fillings that nothing left can extend, and in which no two pieces could be swapped
for one longer piece that is there. Branches whose waste exceeds what a packing better than the
incumbent may waste are cut. The incumbent starts as best-fit decreasing; the search ends when
the lower bound is met or ``MOST_FILLINGS`` fillings were tried, and the incumbent is returned.

Every piece then gets a number within its length, without ordering a length in one task, and the
number says which sequence and offset it has.

Defined cases: a null or empty text is its end marker alone, one token; repeated rows are packed
each; null ids are allowed; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.pieces import PieceIds, RankEncoder, plain_ranks
from starfit.llm.tables import numbered, scanned, staged

CAPACITY = 2048
#: Fillings that the search tries at most.
MOST_FILLINGS = 30_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: (lengths in order of place, how many sequences are filled so)
Filling = tuple[tuple[int, ...], int]


class _Stock:
    """Counts by length, and the lengths present in order."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.tolist()
        self.present = np.flatnonzero(counts).tolist()

    def longest(self, most: int) -> int:
        """The longest length present of at most ``most``, or 0."""
        at = bisect_right(self.present, most)
        return self.present[at - 1] if at else 0

    def add(self, length: int, times: int) -> None:
        before = self.counts[length]
        self.counts[length] = before + times
        if before == 0 and times:
            insort(self.present, length)
        elif before + times == 0 and times:
            del self.present[bisect_right(self.present, length) - 1]

    def times(self, filling: tuple[int, ...]) -> int:
        return min(self.counts[x] // filling.count(x) for x in set(filling))

    def take(self, filling: tuple[int, ...], times: int) -> None:
        for x in set(filling):
            self.add(x, -times * filling.count(x))


def _fill(stock: _Stock, filling: list[int], room: int) -> int:
    """Add the longest piece that fits until none does; returns the room left. Takes the pieces."""
    while at := stock.longest(room):
        filling.append(at)
        stock.add(at, -1)
        room -= at
    return room


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[Filling]:
    """Longest first, each piece to the open sequence with the least room that holds it."""
    open_: dict[int, list[Filling]] = {}  # by room
    rooms: list[int] = []  # those of ``open_``, in order

    def put(room: int, filling: Filling) -> None:
        if room not in open_:
            insort(rooms, room)
        open_.setdefault(room, []).append(filling)

    for x in np.flatnonzero(counts)[::-1].tolist():
        left, at = int(counts[x]), bisect_left(rooms, x)
        grown: list[tuple[int, Filling]] = []
        while left and at < len(rooms):
            # A sequence that takes a piece has the least room then, so it goes on until full.
            room = rooms[at]
            filling, times = open_[room].pop()
            each = min(room // x, left)
            whole = min(times, left // each)
            if whole < times:
                open_[room].append((filling, times - whole))
            grown.append((room - each * x, (filling + (x,) * each, whole)))
            left -= each * whole
            if not open_[room]:
                del open_[room], rooms[at]
        while left:
            each = min(capacity // x, left)
            grown.append((capacity - each * x, ((x,) * each, left // each)))
            left %= each
        for room, filling in grown:
            put(room, filling)
    return [filling for fillings in open_.values() for filling in fillings]


def completions(
    stock: _Stock, longest: int, capacity: int, most: int = 4, steps: int = 400
) -> list[tuple[int, ...]]:
    """Undominated fillings around one piece of length ``longest``, fullest first.

    ``steps`` bounds the pieces tried; the filling by the longest that fits is always among them.
    """
    first = [longest]
    stock.add(longest, -1)
    room = _fill(stock, first, capacity - longest)
    for x in first[1:]:
        stock.add(x, 1)
    found: dict[tuple[int, ...], int] = {tuple(first): room}
    left, full = steps, int(room == 0)

    def extend(filling: tuple[int, ...], room: int, top: int) -> None:
        nonlocal left, full
        if stock.longest(room) == 0:
            full += found.setdefault(filling, room) == 0
            return
        at = stock.longest(min(room, top))
        while at and left > 0 and full < most:
            left -= 1
            stock.add(at, -1)
            extend((*filling, at), room - at, at)
            stock.add(at, 1)
            at = stock.longest(at - 1)

    extend((longest,), capacity - longest, longest)
    stock.add(longest, 1)
    ranked = sorted(found, key=found.get)
    out = [f for f in ranked if found[f] == 0 or not _dominated(stock, f, found[f])]
    return (out or ranked[:1])[:most]


def _dominated(stock: _Stock, filling: tuple[int, ...], room: int) -> bool:
    """Whether two of the added pieces could give way to one at least as long not in the filling."""
    rest = sorted(set(filling[1:]), reverse=True)
    for i, x in enumerate(rest):
        for y in rest[i:]:
            if x != y or filling.count(x) > 1:
                at = stock.longest(min(x + y + room, len(stock.counts) - 1))
                if at >= x + y and at not in filling:
                    return True
    return False


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Whole tokens by capacity, and pieces over half of it, which never share a sequence."""
    lengths = np.arange(len(counts))
    return max(-(-int((counts * lengths).sum()) // capacity), int(counts[capacity // 2 + 1 :].sum()))


def pack_lengths(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = MOST_FILLINGS) -> list[Filling]:
    """Fillings that use every length ``counts[length]`` times, in few sequences.

    ``counts`` has ``capacity + 1`` entries. ``nodes`` bounds the fillings tried.
    """
    best = best_fit_decreasing(counts, capacity)
    bound = lower_bound(counts, capacity)
    total = int((counts * np.arange(len(counts))).sum())
    while sum(n for _, n in best) > bound and nodes > 0:
        allowed = (sum(n for _, n in best) - 1) * capacity - total
        better, nodes = _complete(counts, capacity, allowed, nodes)
        if better is None:
            break
        best = better
    return best


def _complete(counts: np.ndarray, capacity: int, allowed: int, nodes: int) -> tuple[list[Filling] | None, int]:
    """Depth first: a packing that wastes at most ``allowed`` tokens, or none within ``nodes``."""
    stock = _Stock(counts)
    path: list[tuple[Filling, list[tuple[int, ...]], int, int]] = []  # chosen, others, waste before, longest
    waste, longest = 0, capacity
    options: list[tuple[int, ...]] | None = None
    while nodes > 0:
        nodes -= 1
        if options is None:
            longest = stock.longest(longest)
            if longest == 0:
                return [chosen for chosen, *_ in path], nodes
            options = completions(stock, longest, capacity)
        options = [f for f in options if waste + capacity - sum(f) <= allowed]
        if options:
            filling, rest = options[0], options[1:]
            empty = capacity - sum(filling)
            times = stock.times(filling)
            if empty:
                times = max(1, min(times, (allowed - waste) // empty))
            stock.take(filling, times)
            path.append(((filling, times), rest, waste, longest))
            waste += empty * times
            options = None
        else:
            if not path:
                return None, nodes
            (filling, times), options, waste, longest = path.pop()
            stock.take(filling, -times)
    return None, nodes


def token_pieces(
    docs: DataFrame,
    tokenizer_json: str,
    pattern: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every document's ids and end marker, cut where longer than ``capacity``: one row a piece.

    ``tokenizer_json`` is the vocabulary file's content and ``pattern`` parts text as the file
    does. Where the file's ids are the order of its merges, whole texts are encoded by rank;
    else through the file's library, each distinct pre-token of a task once.
    """
    ranks = plain_ranks(tokenizer_json)

    def by_file():
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(tokenizer_json)
        model.encode_special_tokens = True

        def ids(pieces: list[str]) -> list[bytes]:
            found = model.encode_batch_fast(pieces, add_special_tokens=False)
            return [np.array(x.ids, "<u4").tobytes() for x in found]

        encoder = PieceIds(ids, pattern)
        return lambda text: encoder.of(encoder.find(text))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = RankEncoder(ranks, pattern).text if ranks else by_file()
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                n = len(ids) // 4
                first = n if n <= capacity else n % capacity or capacity
                for k, start in enumerate([0, *range(first, n, capacity)]):
                    to = first if k == 0 else start + capacity
                    rows.append((doc_id, k, start, to - start, zlib.crc32(ids[4 * start : 4 * to])))
            columns = zip(*rows) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in PIECES.split(", ")]
            )

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_column).mapInArrow(cut, PIECES)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = MOST_FILLINGS) -> DataFrame:
    """``pieces`` with sequence_id and offset: which sequence holds a piece, and where."""
    found = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in found:
        counts[row.length] = row.n
    # By length: number of the first piece, first sequence, pieces a sequence, offset of the first.
    spans: dict[int, list[tuple[int, int, int, int]]] = {}
    used = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for filling, times in pack_lengths(counts, capacity, nodes):
        offset = 0
        for x in sorted(set(filling), reverse=True):
            each = filling.count(x)
            spans.setdefault(x, []).append((int(used[x]), sequence, each, offset))
            used[x] += each * times
            offset += each * x
        sequence += times
    tables = {x: np.array(rows, np.int64) for x, rows in spans.items()}

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        length = batch.column(3).to_numpy(zero_copy_only=False)
        number = batch.column(5).to_numpy(zero_copy_only=False)
        sequence_id, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for x in np.unique(length):
            at, table = np.flatnonzero(length == x), tables[int(x)]
            first, base, each, shift = table[np.searchsorted(table[:, 0], number[at], "right") - 1].T
            sequence_id[at] = base + (number[at] - first) // each
            offset[at] = shift + (number[at] - first) % each * x
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array(sequence_id), pa.array(offset)],
            names=[*batch.schema.names[:5], "sequence_id", "offset"],
        )

    rows = numbered(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "number", int(counts.sum()))
    names = [x.split()[0] for x in PIECES.split(", ")]
    return scanned(rows.select(*names, "number"), place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_json: str, pattern: str, capacity: int = CAPACITY, **names) -> DataFrame:
    """Tokenize, cut and place all documents."""
    pieces = staged(token_pieces(docs, tokenizer_json, pattern, capacity, **names), "pieces")
    return place_pieces(pieces, capacity)
