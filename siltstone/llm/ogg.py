"""Ogg containers as columns (RFC 3533).

``store_samples`` writes bytes as unsigned 8-bit samples into a physical Ogg stream
of several interleaved logical streams; ``read_streams`` verifies every page's
checksum, resynchronises after damage, reassembles packets from the lacing
values, demultiplexes the logical streams and derives the packets' times
from granule positions.  Both work row by row, without a shuffle.

The Ogg checksum (polynomial 0x04c11db7, most significant bit first, start 0) equals
the bit-reversed register of zlib's CRC-32 over bit-reversed bytes, so it runs at
zlib's speed.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import extended, importable, view

_REVERSE = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))
_HEADER = struct.Struct("<4sBBqIIIB")
_IDENT = struct.Struct("<4sBBBBIQ")
MAGIC = b"SmU8"
CONTINUED, FIRST, LAST = 1, 2, 4
PACKET_BYTES, PAGE_SEGMENTS, RATE = 4096, 64, 8000


def checksum(page: bytes) -> int:
    """Checksum of a page, whose own checksum field counts as zero."""
    r = page.translate(_REVERSE)
    c = zlib.crc32(r[26:], zlib.crc32(b"\0\0\0\0", zlib.crc32(r[:22], 0xFFFFFFFF))) ^ 0xFFFFFFFF
    return int.from_bytes(c.to_bytes(4, "little").translate(_REVERSE), "big")


def page(serial: int, number: int, granule: int, kind: int, lacing: bytes, body: bytes) -> bytes:
    head = bytearray(_HEADER.pack(b"OggS", 0, kind, granule, serial, number, 0, len(lacing)) + lacing)
    head[22:26] = checksum(bytes(head) + body).to_bytes(4, "little")
    return bytes(head) + body


def lacing_of(n: int) -> bytes:
    """255 for each full segment, then one value below 255, so a packet's end is always marked."""
    return b"\xff" * (n // 255) + bytes([n % 255])


@dataclass
class Stream:
    serial: int
    pages: int = 0
    missing: int = 0
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)
    ended: bool = False
    next_page: int | None = None
    partial: bytearray | None = None

    @property
    def rate(self) -> int:
        if self.packets and len(self.packets[0]) == _IDENT.size and self.packets[0][:4] == MAGIC:
            return _IDENT.unpack(self.packets[0])[5]
        return 0

    def seconds(self) -> list[float | None]:
        """End time of each packet; None where no granule position tells.

        A page's granule position is the end of the last packet that ends on it.  In a
        stream of 8-bit samples the packets before it end as many samples earlier
        as the later ones hold bytes.
        """
        if not self.rate:
            return [None] * len(self.packets)
        out: list[float | None] = [None] * len(self.packets)
        at = None
        for k in range(len(self.packets) - 1, -1, -1):
            if self.granules[k] >= 0:
                at = self.granules[k]
            if at is not None:
                out[k] = at / self.rate
                at = max(0, at - len(self.packets[k])) if k else at
        return out


def demux(data: bytes) -> tuple[list[Stream], int]:
    """The logical streams in order of appearance, and the number of pages with a wrong checksum or a cut end."""
    streams: dict[int, Stream] = {}
    bad, at, n = 0, data.find(b"OggS"), len(data)
    while 0 <= at:
        if at + 27 > n:
            bad += 1
            break
        _, version, kind, granule, serial, number, crc, segments = _HEADER.unpack_from(data, at)
        lacing = data[at + 27 : at + 27 + segments]
        end = at + 27 + segments + sum(lacing)
        if version or len(lacing) < segments or end > n or checksum(data[at:end]) != crc:
            bad += 1
            at = data.find(b"OggS", at + 4)
            continue
        s = streams.setdefault(serial, Stream(serial))
        if s.next_page is not None and number != s.next_page:
            s.missing += max(0, number - s.next_page)
            s.partial = None
        s.next_page = number + 1
        s.pages += 1
        s.ended |= bool(kind & LAST)
        # a packet whose beginning was lost is passed over to its end
        lost = bool(kind & CONTINUED) and s.partial is None
        if not kind & CONTINUED:
            s.partial = None
        body, was = at + 27 + segments, len(s.packets)
        begin = body
        for v in lacing:
            body += v
            if v < 255:
                piece = data[begin:body]
                begin = body
                if lost:
                    lost = False
                    continue
                if s.partial is not None:
                    piece = bytes(s.partial) + piece
                    s.partial = None
                s.packets.append(piece)
                s.granules.append(-1)
        if len(s.packets) > was:
            s.granules[-1] = granule
        if segments and lacing[-1] == 255 and not lost:
            s.partial = (s.partial if s.partial is not None else bytearray()) + data[begin:body]
        at = end if data[end : end + 4] == b"OggS" else data.find(b"OggS", end)
    return list(streams.values()), bad


def mux(payload: bytes, streams: int = 2, packet_bytes: int = PACKET_BYTES, page_segments: int = PAGE_SEGMENTS, rate: int = RATE) -> bytes:
    """Packet k of the payload goes to logical stream k mod ``streams``; pages of all streams interleave.

    Each stream starts with an identification packet on a page of its own.
    Serial numbers come from the payload, so equal payloads give equal bytes.
    """
    base = zlib.crc32(payload)
    serials = [(base + k * 0x9E3779B1) & 0xFFFFFFFF for k in range(streams)]
    cut = [payload[i : i + packet_bytes] for i in range(0, len(payload), packet_bytes)]
    out = []
    for k, serial in enumerate(serials):
        ident = _IDENT.pack(MAGIC, 1, streams, k, 8, rate, len(payload))
        out.append(page(serial, 0, 0, FIRST, lacing_of(len(ident)), ident))
    bodies = [[] for _ in serials]
    for k, serial in enumerate(serials):
        mine = cut[k::streams]
        lacing = b"".join(lacing_of(len(p)) for p in mine)
        body, ends, at = b"".join(mine), [], 0
        for p in mine:
            ends.append(at := at + len(p))
        done = number = sent = 0
        for i in range(0, max(1, len(lacing)), page_segments):
            part = lacing[i : i + page_segments]
            size = sum(part)
            closed = sum(v < 255 for v in part)
            kind = (CONTINUED if i and lacing[i - 1] == 255 else 0) | (LAST if i + page_segments >= len(lacing) else 0)
            granule = ends[done + closed - 1] if closed else (-1 if part else 0)
            bodies[k].append(page(serial, number := number + 1, granule, kind, part, body[sent : sent + size]))
            done, sent = done + closed, sent + size
    for i in range(max(map(len, bodies))):
        out += [b[i] for b in bodies if i < len(b)]
    return b"".join(out)


def payload_of(streams: list[Stream]) -> bytes | None:
    """The payload of ``mux``; None if it isn't all there."""
    if not streams or any(s.rate == 0 for s in streams):
        return None
    head = [_IDENT.unpack(s.packets[0]) for s in streams]
    order = sorted(range(len(streams)), key=lambda i: head[i][3])
    if [head[i][3] for i in order] != list(range(head[0][2])):
        return None
    lists = [streams[i].packets[1:] for i in order]
    data = b"".join(p[k] for k in range(max(map(len, lists))) for p in lists if k < len(p))
    return data if len(data) == head[0][6] else None


def _describe(data: bytes | None) -> tuple:
    """pages, bad pages, streams as rows, the payload, and a feature text."""
    streams, bad = demux(data) if data else ([], 0)
    rows = []
    for s in streams:
        seconds = [x for x in s.seconds()[1 if s.rate else 0 :] if x is not None]
        rows.append({"serial": s.serial, "pages": s.pages, "missing_pages": s.missing, "packets": len(s.packets), "bytes": sum(map(len, s.packets)), "rate": s.rate, "first_seconds": seconds[0] if seconds else None, "last_seconds": max(seconds) if seconds else None, "ended": s.ended})
    payload = payload_of(streams)
    x = np.frombuffer(payload or b"", np.uint8)
    level = x.astype(np.float32) - 128
    rms = float(np.sqrt(np.mean(np.square(level, dtype=np.float64)))) if len(x) else 0.0
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    duration = sum(r["last_seconds"] or 0.0 for r in rows)
    feature = f"streams={len(rows)};pages={sum(r['pages'] for r in rows)};bad={bad};packets={sum(r['packets'] for r in rows)};seconds={duration:.6f};rms={rms:.4f};crossings={crossings}"
    return sum(r["pages"] for r in rows), bad, rows, payload, feature


_STREAM_DDL = "array<struct<serial: bigint, pages: bigint, missing_pages: bigint, packets: bigint, bytes: bigint, rate: bigint, first_seconds: double, last_seconds: double, ended: boolean>>"


def store_samples(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", streams: int = 2) -> DataFrame:
    """Each text's UTF-8 bytes, filled with zeros to a positive multiple of 64, as an Ogg file.

    Returns the id column, ``n_bytes`` (unfilled) and ``media``.  Null text: as empty,
    so 64 zero samples.  Null ids and repeated rows pass as they are; an empty table gives
    an empty result; other columns are ignored.
    """
    rows = view(df, id_col, text_col)
    rows = rows.select("_id", F.octet_length("_text").cast("bigint").alias("n_bytes"), F.col("_text").cast("binary").alias("_text"))

    def run(batches):
        for b in batches:
            media = []
            for t in b.column("_text"):
                raw = t.as_py() or b""
                media.append(mux(raw + b"\0" * (-len(raw) % 64 if raw else 64), streams))
            for i in range(0, len(media), 256):
                yield pa.RecordBatch.from_arrays([b.column(0)[i : i + 256], b.column(1)[i : i + 256], pa.array(media[i : i + 256], pa.binary())], names=["_id", "n_bytes", "media"])

    out = rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, n_bytes bigint, media binary")
    return out.withColumnRenamed("_id", id_col)


def read_streams(df: DataFrame, media_col: str = "media") -> DataFrame:
    """Adds to each row what its Ogg bytes hold.

    ``pages`` and ``bad_pages`` (wrong checksum, or cut off), ``streams`` (one entry a logical
    stream in order of appearance: serial, pages, missing pages, packets, bytes, sample rate,
    times of the first and last packet end, whether the last page was seen), ``payload``
    (what ``store_samples`` stored; null if incomplete or of another kind) and ``feature``.
    Null, empty or foreign bytes: no streams, null payload.  A damaged page is
    passed over, and so are packets that began or went on in it.  A column of the
    table that has one of these names is replaced.
    """
    importable(df.sparkSession)
    added = ("pages", "bad_pages", "streams", "payload", "feature")
    df = df.select(*[df[c] for c in df.columns if c.lower() not in added])

    def run(batches):
        for whole in batches:
            at = whole.schema.get_field_index(media_col)
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                got = [_describe(x.as_py()) for x in b.column(at)]
                cols = list(zip(*got)) if got else [[]] * 5
                streams = pa.array(list(cols[2]), pa.list_(pa.struct([("serial", pa.int64()), ("pages", pa.int64()), ("missing_pages", pa.int64()), ("packets", pa.int64()), ("bytes", pa.int64()), ("rate", pa.int64()), ("first_seconds", pa.float64()), ("last_seconds", pa.float64()), ("ended", pa.bool_())])))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), streams, pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.string())], names=[*b.schema.names, *added])

    return df.mapInArrow(run, extended(df, f"pages bigint, bad_pages bigint, streams {_STREAM_DDL}, payload binary, feature string"))
