"""Structure repair of conversations: the cheapest edits that make roles alternate, ASCII-least.

A conversation is a row of turns; its role initials must read ``(s?(ua)+)?``. Four states tell how
far a prefix has come: nothing yet, after ``s``, after ``u``, after ``a``. Turns are kept, given
another role, or deleted, and empty turns inserted, at fixed costs. The state-cost vector before a
turn, the least cost from each state to the end, follows from the one behind it. The forward walk
takes at every step the ASCII-least edit that is tight, so it needs all vectors in order; kept are
only those at every square root of the length, and a block's vectors are worked out again when
the walk gets there.

Rows are put in order by range partitions (``ordered``). A conversation that lies whole in one of
them is solved there. Longer ones, and those that an edge parts, are cut into segments of bounded
rows. A segment's effect on a cost vector is a four-by-four table of least costs, so the vectors at
the segments' ends follow from the tables alone; with these, each segment is walked for every
state it may be entered in; the states it is left in give the entered ones; and the segments' texts
follow. Only tables and states of a conversation's segments, never its turns, meet in a task, and
the digest, which runs over the whole text, is streamed segment by segment.

Faults, the first of which counts: blank (no character but blanks), duplicate (a role and text seen
earlier), truncated (the last character that is no blank is none of ``.!?``).

Defined cases: null roles and texts read as one space; rows come by turn, null turns first, equal
turns by role and text; repeated rows are turns, and duplicates; rows with a null conversation are
one conversation; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.ordered import ordered_pieces, split_groups
from starfit.llm.tables import scanned, staged

#: Turns, and characters of text, from which a segment ends with the turn.
SEGMENT_TURNS = 4_096
SEGMENT_CHARS = 1 << 20

#: Costs of edits, and of a truncated turn that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANKS = " \t\n\v\f\r"
ENDINGS = ".!?"
LEGAL = ("su", "ua", "au")

#: Start, after s, after u, after a. Where ``u`` and ``a`` lead; exactly one is legal in each state.
NEXT = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
GROWN = tuple(max(NEXT["u"][q], NEXT["a"][q]) for q in range(4))
ROLE_OF = tuple("user" if NEXT["u"][q] >= 0 else "assistant" for q in range(4))
NEVER = 1 << 50
ACCEPTED = (0, NEVER, NEVER, 0)

RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)
KEPT, BLANK, DUPLICATE, CUT = range(4)


# ---- The search over one stretch of turns. A turn is (initial, fault).


def grown(vector: list[int]) -> list[int]:
    """The vector when empty turns may be inserted first."""
    out = list(vector)
    for _ in range(3):  # no cheapest way inserts more in a row
        out = [min(out[q], INSERT + out[GROWN[q]]) for q in range(4)]
    return out


def behind(turn: tuple[str, int], vector: Sequence[int]) -> list[int]:
    """Least costs before a turn, from those behind it."""
    initial, fault = turn
    out = [DELETE + v for v in vector]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        kept = NEXT.get(initial)
        for q in range(4):
            out[q] = min(out[q], REROLE + extra + vector[GROWN[q]])
            if kept and kept[q] >= 0:
                out[q] = min(out[q], extra + vector[kept[q]])
    return grown(out)


def before_all(turns: Sequence[tuple[str, int]], end: Sequence[int]) -> list[int]:
    vector = list(end)
    for turn in reversed(turns):
        vector = behind(turn, vector)
    return vector


def walk(turns: Sequence[tuple[str, int]], end: Sequence[int], state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least tight edits from a state, and the state they lead to.

    ``end`` are the least costs behind the last turn. Behind it, empty turns are inserted only
    if ``last``: else they belong to the next stretch.
    """
    n = len(turns)
    size = isqrt(n) + 1
    kept = {n: list(end)}  # vectors at the blocks' edges
    vector = list(end)
    for i in range(n - 1, -1, -1):
        vector = behind(turns[i], vector)
        if i % size == 0:
            kept[i] = vector
    edits: list[str] = []
    for start in range(0, n, size):
        stop = min(n, start + size)
        vectors = [kept[stop]]
        for i in range(stop - 1, start - 1, -1):
            vectors.append(behind(turns[i], vectors[-1]))
        vectors.reverse()
        for i in range(start, stop):
            here, after = vectors[i - start], vectors[i - start + 1]
            initial, fault = turns[i]
            keep = NEXT.get(initial, (-1,) * 4)
            extra = TRUNCATED if fault == CUT else 0
            while True:
                if DELETE + after[state] == here[state]:
                    edits.append("D")
                elif INSERT + here[GROWN[state]] == here[state]:
                    edits.append("I")
                    state = GROWN[state]
                    continue
                elif keep[state] >= 0 and extra + after[keep[state]] == here[state]:
                    edits.append("K")
                    state = keep[state]
                else:
                    edits.append("R")
                    state = GROWN[state]
                break
    while last and ACCEPTED[state] > 0:
        edits.append("I")
        state = GROWN[state]
    return "".join(edits), state


def entered(audit: str, turns: Sequence[tuple[str, int]], state: int) -> Iterator[tuple[str, int | None, int]]:
    """(edit, place of its turn or None, state it is made in) of a walk's edits."""
    at = 0
    for edit in audit:
        place = None if edit == "I" else at
        yield edit, place, state
        if edit == "K":
            state = NEXT[turns[at][0]][state]
        elif edit != "D":
            state = GROWN[state]
        at += edit != "I"


def repaired_turns(
    audit: str, turns: Sequence[tuple[str, int]], roles: list[str], texts: list[str], state: int = 0
) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns that the edits leave."""
    for edit, place, q in entered(audit, turns, state):
        if edit == "K":
            yield roles[place], texts[place]
        elif edit == "R":
            yield ROLE_OF[q], texts[place]
        elif edit == "I":
            yield ROLE_OF[q], ""


# ---- Faults


def seen_key(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def faults(roles: list[str], texts: list[str], seen: set[bytes]) -> list[int]:
    """Each turn's first fault; ``seen`` holds what came earlier and takes up these turns."""
    out = []
    for role, text in zip(roles, texts):
        key, bare = seen_key(role, text), text.rstrip(BLANKS)
        if not bare:
            out.append(BLANK)
        elif key in seen:
            out.append(DUPLICATE)
        else:
            out.append(KEPT if bare[-1] in ENDINGS else CUT)
        seen.add(key)
    return out


@dataclass
class Counts:
    """What a stretch of turns adds up to; stretches are added in order."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    least: int | None = None
    most: int | None = None
    distinct: int = 0
    first: str | None = None
    last: str | None = None

    @staticmethod
    def of(turns: list[int | None], initials: Sequence[str], found: list[int]) -> Counts:
        real = [t for t in turns if t is not None]
        return Counts(
            found.count(BLANK),
            found.count(DUPLICATE),
            found.count(CUT),
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            min(real, default=None),
            max(real, default=None),
            len(set(real)),
            initials[0] if initials else None,
            initials[-1] if initials else None,
        )

    def add(self, other: Counts) -> None:
        if self.last is not None and other.first is not None:
            self.illegal += self.last + other.first not in LEGAL
        for name in ("blank", "duplicate", "truncated", "illegal", "distinct"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if self.most is not None and self.most == other.least:
            self.distinct -= 1  # the turn goes on
        if self.least is None:
            self.least = other.least
        self.most = self.most if other.most is None else other.most
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.distinct

    def row(self) -> tuple[int, ...]:
        return self.gaps, self.blank, self.duplicate, self.truncated, self.illegal


def coded(roles: list[str], found: list[int]) -> list[tuple[str, int]]:
    return [(role[:1], fault) for role, fault in zip(roles, found)]


# ---- Stretches of turns on their way through Spark


@dataclass
class _Stretch:
    at: int = 0
    size: int = 0
    turns: list[int | None] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    @property
    def full(self) -> bool:
        return len(self.turns) >= SEGMENT_TURNS or self.size >= SEGMENT_CHARS


def _solved(stretch: _Stretch) -> tuple:
    """The result of a conversation that is one stretch."""
    found = faults(stretch.roles, stretch.texts, set())
    turns = coded(stretch.roles, found)
    counts = Counts.of(stretch.turns, [t[0] for t in turns], found)
    end = grown(list(ACCEPTED))
    audit, _ = walk(turns, end, 0, True)
    text = "\n".join(f"{r}:{t}" for r, t in repaired_turns(audit, turns, stretch.roles, stretch.texts))
    return (*counts.row(), before_all(turns, end)[0], audit, hashlib.sha256(text.encode()).hexdigest())


_STRETCH = "at long, turns array<long>, roles array<string>, texts array<string>"
_NAMES = [x.split()[0] for x in RESULT.split(", ")]
_KINDS = [pa.int64()] * 7 + [pa.string(), pa.string()]
_LISTS = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _stretches(pieces: DataFrame, split: dict) -> DataFrame:
    """A row for each solved conversation, and one for each stretch of the others."""
    names = [*_NAMES, "at", "turns", "roles", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, stretch, out, size = None, _Stretch(), [], 0

        def close(whole: bool) -> None:
            nonlocal stretch, size
            if whole:
                out.append((key[0], *_solved(stretch), None, None, None, None))
            else:
                out.append((key[0], *[None] * 8, stretch.at, stretch.turns, stretch.roles, stretch.texts))
                size += stretch.size
            stretch = _Stretch()

        for batch in batches:
            for conv, turn, role, text, part, nth, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if stretch.turns and (key != (conv, part) or stretch.full):
                    close(False)
                if not stretch.turns:
                    key = (conv, part)
                    stretch.at = split.get(key, (0, True))[0] + nth
                stretch.add(turn, " " if role is None else role, " " if text is None else text)
                if ends:
                    close(key not in split and stretch.at == 0)
                if size >= SEGMENT_CHARS or len(out) >= SEGMENT_TURNS:
                    yield _batch(out, names, [*_KINDS, *_LISTS])
                    out, size = [], 0
        if stretch.turns:
            close(False)
        yield _batch(out, names, [*_KINDS, *_LISTS])

    return pieces.mapInArrow(run, f"{RESULT}, {_STRETCH}")


def _repeated_elsewhere(stretches: DataFrame) -> DataFrame:
    """conv_id, at, earlier: keys of turns that an earlier stretch of the conversation holds."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for roles, texts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            rows.append(list({seen_key(r, t) for r, t in zip(roles, texts)}))
        keys = pa.array(rows, pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys], names=["conv_id", "at", "keys"])

    keys = scanned(
        stretches.select("conv_id", "at", "roles", "texts"), run, "conv_id long, at long, keys array<binary>"
    )
    keys = staged(keys.select("conv_id", "at", F.explode("keys").alias("key")), "turn-keys")
    first = keys.groupBy("conv_id", "key").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    same = F.col("k.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("k.key") == F.col("f.key"))
    later = keys.alias("k").join(first.alias("f"), same & (F.col("k.at") > F.col("f.first")))
    return later.groupBy("k.conv_id", "k.at").agg(F.collect_list("k.key").alias("earlier"))


def _joined(left: DataFrame, right: DataFrame, value: str) -> DataFrame:
    """``left`` with a value by conversation and place; conversations may be null."""
    own = right.select(F.col("conv_id").alias("_conv"), F.col("at").alias("_at"), value)
    same = left["conv_id"].eqNullSafe(own["_conv"]) & (left["at"] == own["_at"])
    return left.join(own, same, "left").drop("_conv", "_at")


_COUNTS = [*Counts.__dataclass_fields__]
_TABLE = "conv_id long, at long, faults binary, costs array<long>, counts array<string>"


def _tables(stretches: DataFrame) -> DataFrame:
    """Faults of every stretch, its table of least costs from state to state, and its counts."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for conv, at, turns, roles, texts, earlier in zip(*(c.to_pylist() for c in batch.columns)):
            found = faults(roles, texts, set(earlier or ()))
            own = coded(roles, found)
            units = [[0 if q == e else NEVER for q in range(4)] for e in range(4)]
            costs = [c for unit in units for c in before_all(own, unit)]
            counts = Counts.of(turns, [t[0] for t in own], found)
            told = [None if (v := getattr(counts, name)) is None else str(v) for name in _COUNTS]
            rows.append((conv, at, bytes(found), costs, told))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.string())]
        yield _batch(rows, ["conv_id", "at", "faults", "costs", "counts"], kinds)

    return scanned(stretches.select("conv_id", "at", "turns", "roles", "texts", "earlier"), run, _TABLE)


def _ends(tables: DataFrame) -> DataFrame:
    """conv_id, at, end, last: the cost vector behind every stretch; and the conversation's counts."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        vector, rows = grown(list(ACCEPTED)), []
        total = Counts()
        for told in table["counts"].to_pylist():
            values = dict(zip(_COUNTS, told))
            total.add(Counts(**{k: v if k in ("first", "last") else (None if v is None else int(v)) for k, v in values.items()}))
        places, costs = table["at"].to_pylist(), table["costs"].to_pylist()
        for k in range(len(places) - 1, -1, -1):
            rows.append((table["conv_id"][0].as_py(), places[k], vector, k == len(places) - 1, None))
            table_of = [costs[k][4 * e : 4 * e + 4] for e in range(4)]
            vector = [min(table_of[e][q] + vector[e] for e in range(4)) for q in range(4)]
        *head, _ = rows[-1]
        rows[-1] = (*head, [*total.row(), vector[0]])
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.list_(pa.int64())]
        return pa.Table.from_batches([_batch(rows, ["conv_id", "at", "end", "last", "total"], kinds)])

    return tables.groupBy("conv_id").applyInArrow(
        run, "conv_id long, at long, end array<long>, last boolean, total array<long>"
    )


def _walked(stretches: DataFrame) -> DataFrame:
    """Every stretch's edits for each state it may be entered in, and the states they lead to."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for conv, at, roles, found, end, last in zip(*(c.to_pylist() for c in batch.columns)):
            ways = [walk(coded(roles, list(found)), end, q, last) for q in range(4)]
            rows.append((conv, at, [a for a, _ in ways], [q for _, q in ways]))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
        yield _batch(rows, ["conv_id", "at", "audits", "exits"], kinds)

    needed = stretches.select("conv_id", "at", "roles", "faults", "end", "last")
    return scanned(needed, run, "conv_id long, at long, audits array<string>, exits array<long>")


def _entries(walked: DataFrame) -> DataFrame:
    """conv_id, at, entry: the state that each stretch is entered in."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        state, rows = 0, []
        for at, exits in zip(table["at"].to_pylist(), table["exits"].to_pylist()):
            rows.append((table["conv_id"][0].as_py(), at, state))
            state = exits[state]
        return pa.Table.from_batches([_batch(rows, ["conv_id", "at", "entry"], [pa.int64()] * 3)])

    return walked.select("conv_id", "at", "exits").groupBy("conv_id").applyInArrow(
        run, "conv_id long, at long, entry long"
    )


def _told(stretches: DataFrame) -> DataFrame:
    """Every stretch's edits and the repaired turns, as lines that each end with a newline."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for conv, at, roles, texts, found, audits, entry, total in zip(*(c.to_pylist() for c in batch.columns)):
            turns = coded(roles, list(found))
            lines = [f"{r}:{t}\n" for r, t in repaired_turns(audits[entry], turns, roles, texts, entry)]
            rows.append((conv, at, audits[entry], "".join(lines), total))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
        yield _batch(rows, ["conv_id", "at", "audit", "lines", "total"], kinds)

    needed = stretches.select("conv_id", "at", "roles", "texts", "faults", "audits", "entry", "total")
    return scanned(needed, run, "conv_id long, at long, audit string, lines string, total array<long>")


def _digests(told: DataFrame) -> DataFrame:
    """Results of conversations of several stretches, streamed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, total, digest, held, begun = None, [], None, None, "", False

        def row() -> pa.RecordBatch:
            digest.update(held[:-1].encode())  # the last newline joins nothing
            return _batch([(conv, *total, "".join(audit), digest.hexdigest())], _NAMES, _KINDS)

        for batch in batches:
            for own, at, part, lines, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if at == 0:
                    if begun:
                        yield row()
                    conv, audit, total, digest, held, begun = own, [], counts, hashlib.sha256(), "", True
                audit.append(part)
                if lines:
                    digest.update(held.encode())
                    held = lines
        if begun:
            yield row()

    dealt = told.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return dealt.mapInArrow(run, RESULT)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, counts of faults, cost, audit and repaired_sha256 of every conversation."""
    columns = ["conv_id", "turn", "role", "text"]
    turns = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").toDF(*columns)
    pieces = ordered_pieces(turns, "conv_id", [F.col(c) for c in columns[1:]], "turns")
    stretches = staged(_stretches(pieces, split_groups(pieces, "conv_id")), "stretches")
    solved = stretches.where("at is null").select(*_NAMES)
    open_ = stretches.where("at is not null").select("conv_id", "at", "turns", "roles", "texts")
    if open_.limit(1).count() == 0:
        return solved
    tables = staged(_tables(_joined(open_, _repeated_elsewhere(open_), "earlier")), "cost-tables")
    ends = staged(_ends(tables), "cost-vectors")
    known = _joined(_joined(open_, tables, "faults"), ends, "end")
    known = _joined(_joined(known, ends, "last"), ends, "total")
    walked = staged(_walked(known), "walks")
    chosen = _joined(_joined(known, walked, "audits"), staged(_entries(walked), "entries"), "entry")
    return solved.unionByName(_digests(staged(_told(chosen), "repaired")))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of ``conv_id:turn``, one kind in twenty each.

    0 drops the row, 1 empties its text, 2 removes the marks that end sentences, 3 repeats it,
    4 makes it the user's. Nulls are spelt, and read, as one space.
    """
    spelt = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spelt("conv_id"), spelt("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", spelt("role").alias("role"), spelt("text").alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(copies).alias("copy"),
    )


def repair_damaged(rows: DataFrame) -> DataFrame:
    """The results of every conversation of ``rows`` after damage, those without a row left, too."""
    found = repair_conversations(damaged(rows))
    all_ids = rows.select(F.col("conv_id").cast("long").alias("_conv")).distinct()
    joined = all_ids.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in _NAMES[1:7]]
    return joined.select(
        F.col("_conv").alias("conv_id"),
        *numbers,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
