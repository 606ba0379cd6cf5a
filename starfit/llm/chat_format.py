"""Conversations as training text with a loss mask, written by a compiled template and read back.

``template`` compiles a chat template to closures. Turns are put in order by range partitions
(``ordered``), so a conversation of any length is rendered by many tasks: the language lets a turn
depend on its own message and place only. The output has a row for each conversation; a long one,
or one that a partition's edge parts, has several rows, each with the place of its first turn.

Texts are escaped reversibly: between the first character of a control string and the rest of it
goes a backslash, and where backslashes are there already, one more. So no text can hold a control
string, and taking one backslash away from each such place gives the text back.

``read_back`` finds the turns by the control strings in the output alone, and the trained text by
the mask, and digests both. A digest runs over a conversation's whole text in order: conversations
of several rows are therefore dealt by conversation, ordered, and streamed row by row.

Defined cases: null texts and roles are empty; rows come by turn, null turns first, equal turns by
role and text; repeated rows are turns of their own; rows with a null conversation are one
conversation; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.ordered import changes, ordered_pieces, split_groups
from starfit.llm.tables import scanned, staged
from starfit.llm.template import Page, Template

#: Characters of output from which a row ends with the turn.
ROW_CHARS = 1 << 20

#: Control strings, of which none holds another's first character but its own.
CONTROLS = (
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "[SYS]",
    "[/SYS]",
    "[ROLE]",
    "[/ROLE]",
    "[/TURN]",
)

#: Marks every turn; what an assistant says is learned.
TURNS = """{{ bos }}
{%- for message in messages -%}
    {%- if message.role == 'assistant' -%}
        {%- generation -%}{{ message.text | escape }}{%- endgeneration -%}{{ eos }}
    {%- elif message.role == 'user' -%}
        {{ '[INST]' }}{{ message.text | escape }}{{ '[/INST]' }}
    {%- elif message.role == 'system' -%}
        {{ '[SYS]' }}{{ message.text | escape }}{{ '[/SYS]' }}
    {%- else -%}
        {{ '[ROLE]' }}{{ message.role | escape }}{{ '[/ROLE]' }}{{ message.text | escape }}{{ '[/TURN]' }}
    {%- endif -%}
{%- endfor -%}
"""
CONSTANTS = {"bos": "<s>", "eos": "</s>"}

FORMATTED = (
    "conv_id long, at long, n_turns long, formatted string,"
    " spans array<struct<start:long,length:long>>, first boolean, last boolean"
)
RESULT = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


class Escape:
    """Keeps control strings out of texts, reversibly."""

    def __init__(self, controls: tuple[str, ...] = CONTROLS):
        heads = "".join(sorted({regex.escape(c[0]) for c in controls}))
        if any(c[0] in d[1:] or "\\" in d for c in controls for d in controls):
            raise ValueError("a control string's first character may only come first, and none has a backslash")
        tails = "|".join(regex.escape(c[1:]) for c in sorted(controls))
        self.plain = regex.compile(rf"([{heads}]\\*)(?={tails})")
        self.escaped = regex.compile(rf"([{heads}]\\*)\\(?={tails})")

    def put(self, text: str | None) -> str:
        return self.plain.sub(r"\1\\", text or "")

    def take(self, text: str) -> str:
        return self.escaped.sub(r"\1", text)


def turns_template() -> Template:
    return Template(TURNS, {"escape": Escape().put}, CONSTANTS)


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, escaped text) of the turns that ``TURNS`` wrote, found by their marks alone."""
    at = 3 if formatted.startswith("<s>") else 0
    while at < len(formatted):
        if formatted.startswith("[INST]", at):
            role, at, end = "user", at + 6, "[/INST]"
        elif formatted.startswith("[SYS]", at):
            role, at, end = "system", at + 5, "[/SYS]"
        elif formatted.startswith("[ROLE]", at):
            stop = formatted.index("[/ROLE]", at)
            role, at, end = formatted[at + 6 : stop], stop + 7, "[/TURN]"
        else:
            role, end = "assistant", "</s>"
        stop = formatted.index(end, at)
        yield role, formatted[at:stop]
        at = stop + len(end)


def format_conversations(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, at, n_turns, formatted, spans, first, last: the text of conversations and its mask.

    ``at`` is the place of a row's first turn; ``spans`` are in characters of the row's text;
    ``first`` and ``last`` say that the row begins and ends its conversation. Written.
    """
    template = template or turns_template()
    columns = ["conv_id", "turn", "role", "text"]
    turns = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").toDF(*columns)
    pieces = ordered_pieces(turns, "conv_id", [F.col(c) for c in columns[1:]], "turns")
    split = split_groups(pieces, "conv_id")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, done, key = Page(), 0, None
        start = 0
        out: list[tuple] = []
        size = 0

        def close(first: bool, last: bool) -> None:
            nonlocal size, page, done
            spans = [{"start": a, "length": n} for a, n in page.spans]
            out.append((key[0], start, done, page.text, spans, first, last))
            size += page.length
            page, done = Page(), 0

        for batch in batches:
            for conv, role, text, part, nth, ends in zip(*(c.to_pylist() for c in batch.columns)):
                before, final = split.get((conv, part), (0, True))
                if done and (key != (conv, part) or page.length >= ROW_CHARS):
                    close(start == 0, False)
                if not done:
                    key, start = (conv, part), before + nth
                last = ends and final
                template.turn({"role": role or "", "text": text or ""}, before + nth, last, page)
                done += 1
                if ends:
                    close(start == 0, last)
                if size >= ROW_CHARS:
                    yield packed(out)
                    out, size = [], 0
        if done:
            close(start == 0, False)
        yield packed(out)

    def packed(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), _SPANS, pa.bool_(), pa.bool_())
        columns = zip(*out) if out else [()] * len(kinds)
        names = ["conv_id", "at", "n_turns", "formatted", "spans", "first", "last"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    needed = pieces.select("conv_id", "role", "text", "part", "nth", "ends")
    return staged(needed.mapInArrow(render, FORMATTED), "formatted")


@dataclass
class _Digest:
    """What is read back of one conversation, row by row."""

    escape: Escape
    turns: int = 0
    learned: int = 0
    written: int = 0
    turns_hash: object = field(default_factory=hashlib.sha256)
    learned_hash: object = field(default_factory=hashlib.sha256)

    def add(self, formatted: str, spans: list[dict]) -> None:
        for role, text in turns_of(formatted):
            self.turns += 1
            self.turns_hash.update(f"{self.escape.take(role)}\n{self.escape.take(text)}\n".encode())
        for span in spans:
            text = self.escape.take(formatted[span["start"] : span["start"] + span["length"]])
            self.learned += len(text)
            self.learned_hash.update(text.encode())
        self.written += len(formatted)

    def row(self) -> tuple:
        return self.turns, self.turns_hash.hexdigest(), self.learned, self.learned_hash.hexdigest(), self.written


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of the written texts."""

    def packed(ids: list, rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = [ids, *(zip(*rows) if rows else [()] * 5)]
        names = [x.split()[0] for x in RESULT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        escape, rows = Escape(), []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            digest = _Digest(escape)
            digest.add(text, spans)
            rows.append(digest.row())
        yield packed(batch.column(0).to_pylist(), rows)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape = Escape()
        digest, conv = None, None
        for batch in batches:
            new = changes(batch.column(0)).tolist()
            rows = zip(*(c.to_pylist() for c in batch.columns), new)
            for k, (own, text, spans, is_new) in enumerate(rows):
                if digest is None or (own != conv if k == 0 else is_new):
                    if digest is not None:
                        yield packed([conv], [digest.row()])
                    digest, conv = _Digest(escape), own
                digest.add(text, spans)
        if digest is not None:
            yield packed([conv], [digest.row()])

    one_row = F.col("first") & F.col("last")
    columns = ["conv_id", "formatted", "spans"]
    short = scanned(formatted.where(one_row).select(*columns), whole, RESULT)
    parted = formatted.where(~one_row).repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return short.unionByName(parted.select(*columns).mapInArrow(stream, RESULT))
