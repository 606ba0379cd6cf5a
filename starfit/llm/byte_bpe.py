"""Byte-level BPE encoding and decoding with overlapping chunks.

A text longer than ``CHUNK`` characters is cut into chunks that overlap. Each chunk is parted
into pre-tokens on its own, in parallel; since a pre-token depends only on what follows its
start, two neighbours that once have a boundary in common have all later ones in common too.
Stitching keeps the left chunk's boundaries up to the first boundary that both have in the
overlap, and the right chunk's from there. Boundaries within ``MARGIN`` characters of a chunk's
end are not trusted, as the rest of the text could move them. Where a whole overlap has no common
boundary (a very long run of letters or blanks), the two chunks are joined and parted again, so
the result is the whole text's whatever the text. The pieces are then encoded by their ranks, in
parallel (by the boundaries found: blanks parted from what follows would be parted anew), and
decoding puts the tokens' raw bytes together.

Shorter texts are one chunk and need no shuffle.

Defined cases: null and empty texts have no ids; repeated rows are returned as often as they
come; null ids are returned; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.pieces import PieceIds, RankEncoder, read_ranks
from starfit.llm.tables import scanned

CHUNK = 32_768
OVERLAP = 1_024
MARGIN = 8
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
KEY = "doc_id long, key binary"


@dataclass(frozen=True)
class Vocabulary:
    """A rank file's tokens and the pattern that parts text into pre-tokens."""

    ranks: dict[bytes, int]
    pattern: str

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        return Vocabulary(read_ranks(path), pattern)

    def encoder(self) -> RankEncoder:
        return RankEncoder(self.ranks, self.pattern)

    def piece_encoder(self) -> PieceIds:
        coder = self.encoder()
        return PieceIds(lambda pieces: [coder.piece(p) for p in pieces], self.pattern)

    def tokens(self) -> list[bytes]:
        out = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token
        return out


def cuts(find: regex.Pattern, text: str) -> np.ndarray:
    """Ends of the pre-tokens of a text."""
    return np.cumsum(np.fromiter(map(len, find.findall(text)), np.int64))


def stitch(
    find: regex.Pattern, chunks: list[str], ends: list[np.ndarray], size: int
) -> list[tuple[str, np.ndarray]]:
    """Segments of the whole text, each with the ends of its pre-tokens.

    Chunk ``i`` starts at character ``i * size`` and overlaps the next. Neighbours without a
    common boundary are joined, as many as follow each other, and parted again at once.
    """
    segments: list[tuple[str, np.ndarray]] = []

    def give(upto: int) -> None:
        mine = own[(own > from_) & (own <= upto)]
        segments.append((text[from_:upto], mine - from_))

    def common(k: int, text: str, at: int, own: np.ndarray) -> np.ndarray:
        """Boundaries that chunk ``k`` has in common with a text before it, by place in the whole."""
        trusted = own[(own >= k * size - at) & (own <= len(text) - MARGIN)] + at
        return np.intersect1d(trusted, np.append(ends[k], 0) + k * size)

    text, at, own = chunks[0], 0, ends[0]  # the open chunk, its place, its boundaries from there
    from_ = 0  # first character of the open chunk not given out yet
    k = 1
    while k < len(chunks):
        shared = common(k, text, at, own)
        if len(shared):
            give(int(shared[0]) - at)
            text, at, own, from_ = chunks[k], k * size, ends[k], int(shared[0]) - k * size
            k += 1
            continue
        last = k
        while last + 1 < len(chunks) and not len(common(last + 1, chunks[last], last * size, ends[last])):
            last += 1
        text = "".join([text[: k * size - at], *(c[:size] for c in chunks[k:last]), chunks[last]])
        own = from_ + cuts(find, text[from_:])
        k = last + 1
    give(len(text))
    return segments


def parted(text: str, ends: list[int]) -> list[str]:
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def _digests(ids: bytes, tokens: list[bytes]) -> tuple[int, str, str]:
    numbers = np.frombuffer(ids, "<u4").tolist()
    return (
        len(numbers),
        hashlib.sha256(" ".join(map(str, numbers)).encode()).hexdigest(),
        hashlib.sha256(b"".join(map(tokens.__getitem__, numbers))).hexdigest(),
    )


def _result(doc_ids: list, rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
    n, ids, decoded = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc_ids, pa.int64()),
            pa.array(n, pa.int64()),
            pa.array(ids, pa.string()),
            pa.array(decoded, pa.string()),
        ],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def encode_documents(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    pattern = vocabulary.pattern
    tokens: list[bytes] = []
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, by_id = vocabulary.encoder(), vocabulary.tokens()
        for batch in batches:
            found = [_digests(encoder.text(t), by_id) for t in batch.column(1).to_pylist()]
            yield _result(batch.column(0).to_pylist(), found)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern)
        for batch in batches:
            ends = [cuts(find, t).tolist() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ends, pa.list_(pa.int64()))], names=[*batch.schema.names, "ends"]
            )

    def sew(table):
        # Rows that repeat bring each chunk as often; one of each is enough.
        table = table.sort_by("chunk_no")
        numbers = table["chunk_no"].to_numpy()
        copies = int((numbers == 0).sum())
        once = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
        table = table.take(once)
        segments = stitch(
            regex.compile(pattern),
            table["chunk"].to_pylist(),
            [np.array(x, np.int64) for x in table["ends"].to_pylist()],
            chunk,
        )
        n = len(segments)
        return pa.table(
            {
                "doc_id": pa.array([table["doc_id"][0].as_py()] * n, pa.int64()),
                "key": pa.array([table["key"][0].as_py()] * n, pa.binary()),
                "copies": pa.array([copies] * n, pa.int64()),
                "segment_no": pa.array(range(n), pa.int64()),
                "segment": [text for text, _ in segments],
                "ends": pa.array([e for _, e in segments], pa.list_(pa.int64())),
            }
        )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.piece_encoder()
        for batch in batches:
            ids = [encoder.of(parted(*x)) for x in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(ids, pa.binary())], names=[*batch.schema.names[:4], "ids"]
            )

    def join(table):
        table = table.sort_by("segment_no")
        if not tokens:  # once a task
            tokens.extend(vocabulary.tokens())
        found = _digests(b"".join(table["ids"].to_pylist()), tokens)
        copies = table["copies"][0].as_py()
        return pa.Table.from_batches([_result([table["doc_id"][0].as_py()] * copies, [found] * copies)])

    long = F.length("text") > chunk
    count = F.ceil(F.length("text") / F.lit(chunk)).cast("int")
    chunks = (
        rows.where(long)
        .withColumn("key", F.unhex(F.sha2("text", 256)))
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), count - 1)))
        .select(
            "doc_id",
            "key",
            F.col("chunk_no").cast("long").alias("chunk_no"),
            F.substring(F.col("text"), F.col("chunk_no") * chunk + 1, F.lit(chunk + overlap)).alias("chunk"),
        )
    )
    sewn = (
        chunks.mapInArrow(part, f"{KEY}, chunk_no long, chunk string, ends array<long>")
        .groupBy("doc_id", "key")
        .applyInArrow(sew, f"{KEY}, copies long, segment_no long, segment string, ends array<long>")
    )
    encoded = sewn.mapInArrow(encode, f"{KEY}, copies long, segment_no long, ids binary")
    return rows.where(~long).mapInArrow(whole, RESULT).unionByName(
        encoded.groupBy("doc_id", "key").applyInArrow(join, RESULT)
    )
