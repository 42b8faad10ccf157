"""WARC records as a table of chunks.

A record is rows of (archive, record identifier, chunk number, bytes): a payload of any size is cut into CHUNK bytes, so
neither writer nor reader ever builds a record as a whole. Each row carries the SHA-1 of the record up to its end, by
which the reader checks chunk after chunk. The chunks of an archive in order, one after the other, are a WARC 1.1 file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, tune

CHUNK = 1 << 16
#: Revisits up to so many are broadcast (each is under 100 bytes); beyond it they are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Payloads of at least so many bytes are stored once.
MIN_REVISIT_BYTES = 0

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"1970-01-01T00:00:00Z"

CHUNK_SCHEMA = "archive long, record_no long, record_id string, chunk_no long, last boolean, data binary, digest_so_far binary"
CHUNKS = pa.schema(
    [("archive", pa.int64()), ("record_no", pa.int64()), ("record_id", pa.string()), ("chunk_no", pa.int64()), ("last", pa.bool_()), ("data", pa.binary()), ("digest_so_far", pa.binary())]
)
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, stored_bytes long, n_chunks long"
READ = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("stored_bytes", pa.int64()), ("n_chunks", pa.int64())]
)


def base32_sha1(digest: bytes) -> bytes:
    return base64.b32encode(digest)


def record_pieces(page_id: int | None, url: str | None, payload: memoryview, refers_to: int | None) -> tuple[str, Iterator[bytes | memoryview]]:
    """The record's identifier, and its bytes piece by piece."""
    name = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}"
    digest = base32_sha1(hashlib.sha1(payload).digest())
    kind = b"response" if refers_to is None else b"revisit"
    http = HTTP % len(payload)
    body = len(http) + (len(payload) if refers_to is None else 0)
    head = [
        b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <" + name.encode() + b">", b"WARC-Date: " + DATE,
        b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % body, b"WARC-Payload-Digest: sha1:" + digest,
        b"X-Payload-Length: %d" % len(payload),
    ]
    if url is not None:
        # a line break in an address can't end the header
        head.append(b"WARC-Target-URI: " + url.encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A"))
    if page_id is not None:
        head.append(b"X-Page-ID: %d" % page_id)
    if refers_to is not None:
        head += [b"WARC-Profile: " + REVISIT_PROFILE, b"X-Refers-To-Page: %d" % refers_to,
                 b"WARC-Refers-To: <" + f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}".encode() + b">"]

    def pieces() -> Iterator[bytes | memoryview]:
        yield b"\r\n".join(head) + b"\r\n\r\n" + http
        if refers_to is None:
            for at in range(0, len(payload), CHUNK):
                yield payload[at : at + CHUNK]
        yield b"\r\n\r\n"

    return name, pieces()


def chunks_of(pieces: Iterator[bytes | memoryview]) -> Iterator[tuple[int, bool, bytes, bytes]]:
    """(chunk number, whether last, bytes, SHA-1 so far) of at most CHUNK bytes each."""
    digest, n, held, size = hashlib.sha1(), 0, [], 0
    for piece in pieces:
        while size + len(piece) > CHUNK:
            room = CHUNK - size
            data = b"".join([*held, piece[:room]])
            digest.update(data)
            yield n, False, data, digest.digest()
            n, held, size, piece = n + 1, [], 0, piece[room:]
        held.append(piece)
        size += len(piece)
    data = b"".join(held)
    digest.update(data)
    yield n, True, data, digest.digest()


def write_archive(pages: DataFrame) -> DataFrame:
    """Chunk rows of a record per row of pages (page_id, url, html, refers_to); an archive a task, records in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, number, rows, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for page_id, url, html, refers_to in zip(*batch.columns, strict=True):
                payload = memoryview(html.as_buffer()) if html.is_valid else memoryview(b"")
                name, pieces = record_pieces(page_id.as_py(), url.as_py(), payload, refers_to.as_py())
                for n, last, data, so_far in chunks_of(pieces):
                    rows.append((archive, number, name, n, last, data, so_far))
                    size += len(data)
                    if size >= 64 * CHUNK:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), CHUNKS.types, strict=True)], schema=CHUNKS)
                        rows, size = [], 0
                number += 1
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), CHUNKS.types, strict=True)], schema=CHUNKS)

    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").cast("binary").alias("html"),
        F.col("refers_to").cast("long").alias("refers_to"),
    ).mapInArrow(run, CHUNK_SCHEMA)


class RecordReader:
    """Takes a record's bytes chunk by chunk; keeps the headers and a digest of the payload, never the payload."""

    def __init__(self) -> None:
        self.head = bytearray()
        self.fields: dict[str, str] | None = None
        self.whole, self.payload = hashlib.sha1(), hashlib.sha1()
        self.left = self.http_left = self.payload_bytes = self.stored = self.chunks = 0

    def feed(self, number: int, data: bytes, so_far: bytes) -> None:
        if number != self.chunks:
            raise ValueError(f"chunk {number} stands where {self.chunks} should")
        self.whole.update(data)
        if self.whole.digest() != so_far:
            raise ValueError(f"chunk {number} doesn't have the digest that was written with it")
        self.chunks += 1
        self.stored += len(data)
        view = memoryview(data)
        if self.fields is None:
            self.head += view
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                return
            lines = self.head[:end].decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("no WARC record starts here")
            self.fields = dict(x.split(": ", 1) for x in lines[1:])
            self.left = int(self.fields["Content-Length"])
            view = memoryview(bytes(self.head[end + 4 :]))
            self.head = bytearray()
            self.http_left = -1
        view = view[: self.left]
        self.left -= len(view)
        if self.http_left:
            self.head += view
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                return
            view, self.http_left = memoryview(bytes(self.head[end + 4 :])), 0
        self.payload.update(view)
        self.payload_bytes += len(view)

    def row(self) -> tuple:
        f = self.fields
        if f is None or self.left:
            raise ValueError("the record ends before its length")
        kind, told = f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (base32_sha1(self.payload.digest()).decode() != told or self.payload_bytes != int(f["X-Payload-Length"])):
            raise ValueError("the payload isn't the one that was written")
        page, refers = f.get("X-Page-ID"), f.get("X-Refers-To-Page")
        return page and int(page), int(f["X-Payload-Length"]), told, kind, refers and int(refers), self.stored, self.chunks


def read_archive(chunks: DataFrame, ordered: bool = False) -> DataFrame:
    """Read records back from chunk rows and check them; ordered: each partition holds whole records in order."""
    if not ordered:
        chunks = chunks.repartition("archive", "record_no").sortWithinPartitions("archive", "record_no", "chunk_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, rows = RecordReader(), []
        for batch in batches:
            for number, last, data, so_far in zip(*batch.columns, strict=True):
                reader.feed(number.as_py(), data.as_py(), so_far.as_py())
                if last.as_py():
                    rows.append(reader.row())
                    reader = RecordReader()
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), READ.types, strict=True)], schema=READ)
                rows = []
        if reader.chunks:
            raise ValueError("the archive ends inside a record")

    return chunks.select("chunk_no", "last", "data", "digest_so_far").mapInArrow(run, READ_SCHEMA)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """pages (page_id, url, html) with refers_to: of equal payloads, the smallest page_id; null for that page itself.

    Payloads are equal if SHA-1 and length are. A null page_id never is referred to, and refers to a payload's smallest
    identifier if there is one. Rows with the same identifier and payload all are responses.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select("page_id", "url", "html", F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("n"))
    known = stored(keyed.select("page_id", "sha", "n"))
    first = known.filter(F.col("n") >= min_bytes).groupBy("sha", "n").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    repeats = first.filter((F.col("copies") > 1) & F.col("first_id").isNotNull())
    revisits = (
        known.join(repeats, ["sha", "n"])
        .filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
        .select(F.col("page_id").alias("r_id"), F.col("sha").alias("r_sha"), F.col("first_id").alias("refers_to"))
        .distinct()
    )
    revisits = stored(revisits)
    if revisits.count() <= BROADCAST_ROWS:
        revisits = F.broadcast(revisits)
    return keyed.join(revisits, keyed.page_id.eqNullSafe(revisits.r_id) & (keyed.sha == revisits.r_sha), "left").select("page_id", "url", "html", "refers_to")


def archive_and_read(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record per row of pages, store the chunks, read them back.

    Null html counts as an empty payload, a null url leaves its header out. Empty table: no rows. Other columns are ignored.
    """
    tune(pages.sparkSession)
    return read_archive(stored(write_archive(with_revisits(pages, min_bytes))), ordered=True)
