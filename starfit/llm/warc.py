"""WARC archives compressed with an embedded dictionary.

Every task writes archives of its own: a skippable frame that holds a Zstandard dictionary, then
one frame per record. The dictionary is trained on at most ``MAX_SAMPLES`` records of up to
``SAMPLE_BYTES`` bytes, those of the rows with the smallest hash; a short input whose samples
do not suffice for training gives its records themselves as dictionary. Files go to the shared
folder under names of their own, and the written table of names counts only what finished tasks
reported, so a retried task leaves no trace in the result. Files are opened through
``pyarrow.fs``, which takes local, HDFS and object-store addresses.

Of records with equal payloads of at least ``min_payload`` bytes, the one with the largest page
id is a response and the others are revisits that refer to it. Payloads are compared by SHA-256.

Defined cases: a null page is an empty payload; a null address is left out of its record; rows
that repeat a page id and payload are all responses where that page is the largest; a null page
id is smaller than any other and, if alone with its payload, a response; other columns are not
read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.tables import hash_share, staged
from starfit.sources.staging import staging_path

# Fixed values of the formats.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_FRAME = 0x184D2A5D
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

DICTIONARY_BYTES = 64 << 10
MAX_SAMPLES = 400
SAMPLE_BYTES = 64 << 10
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}/{payload_digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> bytes:
    """One record; a revisit keeps the HTTP head of its page, and with it the payload's length."""
    own = digest(payload)
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id, own)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{own}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(first, own)), ("Refers-To-Page-Id", str(first))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of a decompressed archive."""
    while line := stream.readline():
        if line != VERSION:
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) != b"\r\n":
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[key] = value
        size = int(fields["Content-Length"])
        block, end = stream.read(size), stream.read(4)
        if len(block) != size or end != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield fields, block


def train_dictionary(samples: list[bytes]) -> bytes:
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        return b"".join(samples)[-DICTIONARY_BYTES:]


def open_archive(content: bytes) -> io.BufferedReader:
    """The records of an archive: the leading skippable frame is its dictionary."""
    kind, size = int.from_bytes(content[:4], "little"), int.from_bytes(content[4:8], "little")
    if kind != DICTIONARY_FRAME:
        raise ValueError("the archive does not start with a dictionary frame")
    known = zstandard.ZstdCompressionDict(content[8 : 8 + size]) if size else None
    frames = zstandard.ZstdDecompressor(dict_data=known).stream_reader(content[8 + size :], read_across_frames=True)
    return io.BufferedReader(frames, 1 << 20)


def _keyed(pages: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    raw = F.coalesce(F.col(html_column), F.lit("")).cast("binary")
    return pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).alias("url"),
        raw.alias("payload"),
        F.unhex(F.sha2(raw, 256)).alias("key"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    min_payload: int = 0,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Write all pages to archives under ``folder``; returns the table of (path, records)."""
    rows = _keyed(pages, id_column, url_column, html_column)
    firsts = rows.groupBy("key").agg(F.max("page_id").alias("first"))
    revisit = (F.octet_length("payload") >= min_payload) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(firsts, "key").select("page_id", "url", "payload", "first", revisit.alias("revisit"))
    # Few more than MAX_SAMPLES records of up to SAMPLE_BYTES bytes are drawn by a hash, and at most
    # MAX_SAMPLES come to the driver, however many tasks there are.
    small = rows.where(F.octet_length("payload") <= SAMPLE_BYTES)
    drawn = hash_share(F.xxhash64("page_id", "key"), 2 * MAX_SAMPLES, small.count())
    sample = small.where(drawn).orderBy(F.xxhash64("page_id", "key")).limit(MAX_SAMPLES).collect()
    dictionary = train_dictionary([record(r.page_id, r.url, bytes(r.payload), None, False) for r in sample])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known)
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, size, count = None, "", 0, 0
        paths, counts = [], []

        def close():
            out.close()
            paths.append(f"{folder}/{name}")
            counts.append(count)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(DICTIONARY_FRAME.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary)
                frame = packer.compress(record(*row))
                out.write(frame)
                size, count = size + len(frame), count + 1
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "records"])

    return staged(joined.mapInArrow(write, "path string, records long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Columns of ``RECORDS`` for every record of the archives in the table of paths.

    A response's payload is checked against its digest.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, at = pafs.FileSystem.from_uri(path)
                with files.open_input_stream(at, compression=None) as stream:
                    content = stream.read()
                rows = []
                for fields, block in records_of(open_archive(content)):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    own, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                    if kind == "response" and (len(payload) != size or digest(payload) != own):
                        raise ValueError(f"{path}: the payload of {fields['WARC-Record-ID']} is not what was archived")
                    number, first = fields.get("Page-Id"), fields.get("Refers-To-Page-Id")
                    rows.append((number and int(number), size, own, kind, first and int(first)))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                columns = zip(*rows) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in RECORDS.split(", ")]
                )

    return archives.select("path").mapInArrow(read, RECORDS)


def archive_folder(pages: DataFrame) -> str:
    """A fresh folder for archives in the shared folder, as an address."""
    path = staging_path(pages.sparkSession, "warc")
    return path if ":/" in path else f"file://{path}"
