"""MPEG transport streams: writing a payload as one, and reading one back.

The writer makes one program with one private elementary stream: PAT, PMT, then PES packets of at most PES_BYTES, each
with a presentation timestamp and each starting at a random-access point that carries a clock reference. The reader
knows nothing of the writer: it follows PAT and PMT, checks each continuity counter, reassembles PES packets by
identifier, and reports timestamps and random-access points.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import tune

# Fixed values of the format (ISO/IEC 13818-1).
PACKET, SYNC, PAT_PID, NULL_PID = 188, 0x47, 0, 0x1FFF
PRIVATE_STREAM_1, PRIVATE_DATA = 0xBD, 0x06
PMT_PID, ES_PID, PROGRAM = 0x100, 0x101, 1
#: Stream identifiers whose PES packets have no optional header.
BARE_STREAMS = (0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF)

PES_BYTES = 32_000
#: Ticks of the 90 kHz clock between PES packets.
PES_TICKS = 3_600


def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        c = n << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7) if c & 0x80000000 else c << 1
        table.append(c & 0xFFFFFFFF)
    return table


_TABLE = _crc_table()


def section_crc(data: bytes) -> int:
    """CRC-32/MPEG-2; 0 over a section that ends with its own checksum."""
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _TABLE[(c >> 24) ^ b]
    return c


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table_id, 0xB000 | (len(body) + 9), number, 0xC1, 0, 0) + body
    return head + struct.pack(">I", section_crc(head))


def _table_packet(pid: int, section: bytes) -> bytes:
    return (struct.pack(">BHB", SYNC, 0x4000 | pid, 0x10) + b"\0" + section).ljust(PACKET, b"\xff")


_TABLES = _table_packet(PAT_PID, _section(0, 1, struct.pack(">HH", PROGRAM, 0xE000 | PMT_PID))) + _table_packet(
    PMT_PID, _section(2, PROGRAM, struct.pack(">HHBHH", 0xE000 | ES_PID, 0xF000, PRIVATE_DATA, 0xE000 | ES_PID, 0xF000))
)


def _timestamp(ticks: int) -> bytes:
    return struct.pack(">BHH", 0x21 | (ticks >> 29) & 0x0E, (ticks >> 14) & 0xFFFE | 1, (ticks << 1) & 0xFFFE | 1)


def write_stream(payload: bytes) -> bytes:
    """The payload as a transport stream; an empty one gives the tables alone."""
    out, counter = [_TABLES], 0
    for n, at in enumerate(range(0, len(payload), PES_BYTES)):
        ticks = (n * PES_TICKS) & 0x1FFFFFFFF
        part = payload[at : at + PES_BYTES]
        pes = struct.pack(">IHBBB", 0x100 | PRIVATE_STREAM_1, len(part) + 8, 0x84, 0x80, 5) + _timestamp(ticks) + part
        # first packet: random-access indicator and clock reference, 8 bytes of adaptation field
        clock = struct.pack(">BBIH", 7, 0x50, (ticks >> 1) & 0xFFFFFFFF, (ticks & 1) << 15 | 0x7E00)
        room = PACKET - 4 - len(clock)
        if len(pes) < room:
            clock = bytes([7 + room - len(pes)]) + clock[1:] + b"\xff" * (room - len(pes))
            room = len(pes)
        out.append(struct.pack(">BHB", SYNC, 0x4000 | ES_PID, 0x30 | counter) + clock + pes[:room])
        counter = (counter + 1) & 15
        full = room + (len(pes) - room) // 184 * 184
        for i in range(room, full, 184):
            out.append(b"G" + ES_PID.to_bytes(2, "big") + bytes((0x10 | counter,)) + pes[i : i + 184])
            counter = (counter + 1) & 15
        if full < len(pes):
            rest = len(pes) - full
            pad = 183 - rest
            field_bytes = bytes([pad]) + (b"\0" + b"\xff" * (pad - 1) if pad else b"")
            out.append(struct.pack(">BHB", SYNC, ES_PID, 0x30 | counter) + field_bytes + pes[full:])
            counter = (counter + 1) & 15
    return b"".join(out)


@dataclass
class Elementary:
    """One elementary stream: its type, whole PES payloads, their timestamps, and where decoding can start."""

    kind: int
    packets: list[bytes] = field(default_factory=list)
    pts: list[int | None] = field(default_factory=list)
    random_access: list[int] = field(default_factory=list)
    counter_errors: int = 0
    duplicates: int = 0


@dataclass
class Stream:
    programs: dict[int, int] = field(default_factory=dict)
    streams: dict[int, Elementary] = field(default_factory=dict)
    clocks: int = 0
    n_packets: int = 0
    lost_sync: int = 0
    bad_sections: int = 0


def _sections(data: bytes, spoiled: Stream) -> Iterator[bytes]:
    at = 1 + data[0] if data else 0
    while at + 3 <= len(data) and data[at] != 0xFF:
        size = 3 + ((data[at + 1] & 15) << 8 | data[at + 2])
        section = data[at : at + size]
        if len(section) < max(size, 12):
            return
        if section_crc(section):
            spoiled.bad_sections += 1
        else:
            yield section
        at += size


def _close(es: Elementary, parts: list[bytes], access: bool) -> None:
    pes = b"".join(parts)
    if len(pes) < 6 or pes[:3] != b"\0\0\1":
        return
    size, body, pts = struct.unpack_from(">H", pes, 4)[0], 6, None
    if pes[3] not in BARE_STREAMS and len(pes) >= 9:
        body = 9 + pes[8]
        if pes[7] & 0x80 and len(pes) >= 14:
            a, b, c = struct.unpack_from(">BHH", pes, 9)
            pts = (a >> 1 & 7) << 30 | (b >> 1) << 15 | c >> 1
    es.packets.append(pes[body : 6 + size] if size else pes[body:])
    es.pts.append(pts)
    if access:
        es.random_access.append(len(es.packets) - 1)


def read_stream(data: bytes) -> Stream:
    """Parse a transport stream.

    Bytes out of sync are skipped to the next sync byte and counted. A repeated packet (same counter) is dropped and
    counted; a gap in the counter is counted and spoils the PES packet under way, which then isn't returned, unless the
    discontinuity indicator allows it. Sections with a false checksum are counted and ignored. Scrambled packets and
    those flagged with a transport error are ignored.
    """
    out = Stream()
    tables: dict[int, list[bytes]] = {}
    pmts: set[int] = set()
    last: dict[int, int] = {}
    open_pes: dict[int, tuple[list[bytes], bool]] = {}

    def flush_table(pid: int) -> None:
        for s in _sections(b"".join(tables.pop(pid, [])), out):
            if pid == PAT_PID and s[0] == 0:
                for i in range(8, len(s) - 4, 4):
                    number, at = struct.unpack_from(">HH", s, i)
                    if number:
                        out.programs[number] = at & 0x1FFF
                        pmts.add(at & 0x1FFF)
            elif s[0] == 2 and pid in pmts:
                i = 12 + ((s[10] & 15) << 8 | s[11])
                while i + 5 <= len(s) - 4:
                    kind, es_pid, info = s[i], struct.unpack_from(">H", s, i + 1)[0] & 0x1FFF, struct.unpack_from(">H", s, i + 3)[0] & 0xFFF
                    out.streams.setdefault(es_pid, Elementary(kind))
                    i += 5 + info

    def table_done(pid: int) -> bool:
        got = b"".join(tables[pid])
        if len(got) < 1 or len(got) < 4 + got[0]:
            return False
        return len(got) >= 1 + got[0] + 3 + ((got[2 + got[0]] & 15) << 8 | got[3 + got[0]])

    at, size = 0, len(data)
    while at + PACKET <= size:
        if data[at] != SYNC:
            after = data.find(b"G", at)
            out.lost_sync += (after if after >= 0 else size) - at
            if after < 0:
                break
            at = after
            continue
        flags, pid, control = data[at + 1], (data[at + 1] & 0x1F) << 8 | data[at + 2], data[at + 3]
        out.n_packets += 1
        start, end = at + 4, at + PACKET
        at = end
        if pid == NULL_PID or flags & 0x80 or control & 0xC0:
            continue
        access = jump = False
        if control & 0x20:
            length = data[start]
            if length:
                bits = data[start + 1]
                jump, access = bool(bits & 0x80), bool(bits & 0x40)
                out.clocks += bool(bits & 0x10)
            start += 1 + length
        if not control & 0x10 or start >= end:
            continue
        es, counter = out.streams.get(pid), control & 15
        if pid in last and not jump:
            if counter == last[pid]:
                if es:
                    es.duplicates += 1
                continue
            if counter != (last[pid] + 1) & 15:
                tables.pop(pid, None)
                if es:
                    es.counter_errors += 1
                    open_pes.pop(pid, None)
        last[pid] = counter
        if pid == PAT_PID or pid in pmts:
            if flags & 0x40:
                flush_table(pid)
                tables[pid] = []
            if pid in tables:
                tables[pid].append(data[start:end])
                if table_done(pid):
                    flush_table(pid)
        elif es is not None:
            if flags & 0x40:
                if pid in open_pes:
                    _close(es, *open_pes[pid])
                open_pes[pid] = ([data[start:end]], access)
            elif pid in open_pes:
                open_pes[pid][0].append(data[start:end])
    for pid in list(tables):
        flush_table(pid)
    for pid, (parts, access) in open_pes.items():
        _close(out.streams[pid], parts, access)
    return out


def feature_of(stream: Stream) -> str:
    """What was found, as one line: programs, streams with packets, timestamps, random-access points and errors."""
    parts = [f"packets={stream.n_packets}", f"clocks={stream.clocks}", f"lost={stream.lost_sync}", f"bad={stream.bad_sections}"]
    parts += [f"program={n}@{pid}" for n, pid in sorted(stream.programs.items())]
    for pid, es in sorted(stream.streams.items()):
        times = [t for t in es.pts if t is not None]
        parts.append(
            f"stream={pid}:type={es.kind}:pes={len(es.packets)}:pts={min(times, default=-1)}-{max(times, default=-1)}"
            f":access={len(es.random_access)}:gaps={es.counter_errors}:repeats={es.duplicates}"
        )
    return ";".join(parts)


SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string,"
    " first_pts long, last_pts long, n_random_access long, counter_errors long"
)
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
     ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("first_pts", pa.int64()), ("last_pts", pa.int64()),
     ("n_random_access", pa.int64()), ("counter_errors", pa.int64())]
)


def padded(text: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")


def media_row(text: bytes) -> tuple:
    media = write_stream(padded(text))
    stream = read_stream(media)
    es = stream.streams[ES_PID]
    payload = b"".join(es.packets)
    times = [t for t in es.pts if t is not None]
    return (
        len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(),
        feature_of(stream), min(times), max(times), len(es.random_access), es.counter_errors,
    )


def media_column(docs: DataFrame) -> DataFrame:
    """Each row's text as a stored transport stream, read back: sizes, digests and what the reader found.

    docs has doc_id and text; other columns are ignored. Null text counts as empty: 64 zero bytes. Rows that repeat give
    rows that repeat. One text and its stream are in memory at a time.
    """
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [media_row(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), *(pa.array(c, ARROW.field(n + 1).type) for n, c in enumerate(zip(*rows, strict=True)))], schema=ARROW) if rows else pa.RecordBatch.from_pylist([], ARROW)

    return docs.select(docs.doc_id.cast("long").alias("doc_id"), docs.text.cast("binary").alias("text")).mapInArrow(run, SCHEMA)
