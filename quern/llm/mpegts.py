"""MPEG transport streams: writing, parsing, and tables of what a stream holds.

A stream holds one programme with one elementary stream of private data.  Each packetized
elementary packet carries one access unit with a presentation time stamp; the transport
packet that begins it carries a clock reference and the random-access mark.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from .common import arrow_schema, map_rows, slices, typed

# Fixed values of ISO/IEC 13818-1.
PACKET, SYNC, PAT_PID, NULL_PID, CLOCK = 188, 0x47, 0, 0x1FFF, 90_000
PRIVATE_DATA, PRIVATE_STREAM = 0x06, 0xBD

# Our streams.
PMT_PID, DATA_PID, PROGRAMME = 0x1000, 0x0100, 1
UNIT = 32_768
UNITS_A_SECOND = 25


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        c = byte << 24
        for _ in range(8):
            c = (c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1
        table.append(c & 0xFFFFFFFF)
    return table


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8) & 0xFFFFFFFF ^ _CRC[c >> 24 ^ b]
    return c


def _section(table: int, ident: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + ident.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + section_crc(head + body).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes, counter: int) -> bytes:
    head = bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10 | counter & 15, 0])
    return (head + section).ljust(PACKET, b"\xff")


_PAT = _section(0, 1, PROGRAMME.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
_PMT = _section(2, PROGRAMME, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_DATA]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00")


def _stamp(mark: int, t: int) -> bytes:
    t &= (1 << 33) - 1
    return bytes([mark << 4 | t >> 29 & 14 | 1, t >> 22 & 255, t >> 14 & 254 | 1, t >> 7 & 255, t << 1 & 254 | 1])


def _read_stamp(b: bytes) -> int:
    return (b[0] & 14) << 29 | b[1] << 22 | (b[2] & 254) << 14 | b[3] << 7 | b[4] >> 1


def write(payload: bytes, unit: int = UNIT) -> bytes:
    """A transport stream that holds payload as access units of ``unit`` bytes."""
    out, counter = [], 0
    head = bytes([SYNC, DATA_PID >> 8, DATA_PID & 0xFF])
    start = bytes([SYNC, 0x40 | DATA_PID >> 8, DATA_PID & 0xFF])
    for k, at in enumerate(range(0, len(payload), unit)):
        out += [_table_packet(PAT_PID, _PAT, k), _table_packet(PMT_PID, _PMT, k)]
        time = (k + 1) * CLOCK // UNITS_A_SECOND
        data = payload[at : at + unit]
        pes = b"\x00\x00\x01" + bytes([PRIVATE_STREAM]) + (len(data) + 8).to_bytes(2, "big") + b"\x80\x80\x05" + _stamp(2, time) + data
        clock = ((time << 15) | 0x7E00).to_bytes(6, "big")  # the extension of the clock is 0
        room = PACKET - 4 - 8
        fill = max(0, room - len(pes))
        out.append(start + bytes([0x30 | counter & 15, 7 + fill, 0x50]) + clock + b"\xff" * fill + pes[:room])
        counter += 1
        whole = (len(pes) - room) // (PACKET - 4) if len(pes) > room else 0
        for i in range(whole):
            out.append(head + bytes([0x10 | counter & 15]) + pes[room + i * 184 : room + i * 184 + 184])
            counter += 1
        if rest := pes[room + whole * 184 :]:
            pad = 183 - len(rest)
            field_ = bytes([pad]) + (b"\x00" + b"\xff" * (pad - 1) if pad else b"")
            out.append(head + bytes([0x30 | counter & 15]) + field_ + rest)
            counter += 1
    return b"".join(out)


@dataclass
class Unit:
    """One elementary packet: its stream, times (90 kHz), whether playing may begin there, its first packet's place, its data."""

    pid: int
    pts: int | None
    dts: int | None
    random_access: bool
    offset: int
    data: bytes
    whole: bool = True


@dataclass
class Parsed:
    packets: int = 0
    programmes: dict[int, int] = field(default_factory=dict)
    streams: dict[int, int] = field(default_factory=dict)
    clocks: list[int] = field(default_factory=list)
    #: (offset, pid, counter expected, counter found)
    gaps: list[tuple[int, int, int, int]] = field(default_factory=list)
    bad_sync: int = 0
    bad_tables: int = 0
    units: list[Unit] = field(default_factory=list)


def _tables(got: Parsed, pid: int, body: bytes) -> None:
    section = body[1 + body[0] :] if body else b""
    size = int.from_bytes(section[1:3], "big") & 0xFFF if len(section) >= 3 else 0
    section = section[: size + 3]
    if size < 9 or len(section) < size + 3 or section_crc(section[:-4]) != int.from_bytes(section[-4:], "big"):
        got.bad_tables += 1
    elif section[0] == 0 and pid == PAT_PID:
        for i in range(8, len(section) - 4, 4):
            if number := int.from_bytes(section[i : i + 2], "big"):
                got.programmes[int.from_bytes(section[i + 2 : i + 4], "big") & 0x1FFF] = number
    elif section[0] == 2:
        at = 12 + (int.from_bytes(section[10:12], "big") & 0xFFF)
        while at + 5 <= len(section) - 4:
            got.streams[int.from_bytes(section[at + 1 : at + 3], "big") & 0x1FFF] = section[at]
            at += 5 + (int.from_bytes(section[at + 3 : at + 5], "big") & 0xFFF)


def _unit(got: Parsed, pid: int, pieces: list) -> None:
    (offset, access), *chunks = pieces
    pes = b"".join(chunks)
    if len(pes) < 9 or pes[:3] != b"\x00\x00\x01":
        return
    size, flags, head = int.from_bytes(pes[4:6], "big"), pes[7], 9 + pes[8]
    pts = _read_stamp(pes[9:14]) if flags & 0x80 and head >= 14 else None
    dts = _read_stamp(pes[14:19]) if flags & 0x40 and head >= 19 else pts
    end = size + 6 if size else len(pes)
    got.units.append(Unit(pid, pts, dts, access, offset, pes[head:end], len(pes) >= end))


def parse(stream: bytes) -> Parsed:
    """Read a stream.  Faults (lost sync, gaps in counters, bad tables, cut units) are told, never raised."""
    got, counters, open_units, seen = Parsed(), {}, {}, {}
    at, end = 0, len(stream)
    while at + PACKET <= end:
        if stream[at] != SYNC:
            got.bad_sync += 1
            at = stream.find(SYNC, at + 1)
            if at < 0:
                break
            continue
        pid, flags = (stream[at + 1] & 31) << 8 | stream[at + 2], stream[at + 3]
        first, has_field, has_body, counter = stream[at + 1] & 0x40, flags & 0x20, flags & 0x10, flags & 15
        got.packets += 1
        body, jump, access = at + 4, False, False
        if has_field:
            size = stream[at + 4]
            body += 1 + size
            if size:
                mark = stream[at + 5]
                jump, access = bool(mark & 0x80), bool(mark & 0x40)
                if mark & 0x10 and size >= 7:
                    got.clocks.append(int.from_bytes(stream[at + 6 : at + 12], "big") >> 15)
        if pid != NULL_PID and has_body:
            if pid in counters and not jump and counter != (due := counters[pid] + 1 & 15):
                if counter == counters[pid]:  # a packet sent twice counts once
                    at += PACKET
                    continue
                got.gaps.append((at, pid, due, counter))
            counters[pid] = counter
            if pid == PAT_PID or pid in got.programmes:
                if first:
                    section = stream[body : at + PACKET]
                    if seen.get(pid) != section:
                        _tables(got, pid, section)
                        seen[pid] = section
            elif pid in got.streams:
                if first:
                    if pid in open_units:
                        _unit(got, pid, open_units[pid])
                    open_units[pid] = [(at, access)]
                if pid in open_units:
                    open_units[pid].append(stream[body : at + PACKET])
        at += PACKET
    for pid, pieces in open_units.items():
        _unit(got, pid, pieces)
    return got


def padded(text: str | None) -> tuple[int, bytes]:
    """The text's length in UTF-8, and its bytes up to a positive multiple of 64 with zeros."""
    raw = (text or "").encode()
    return len(raw), raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\x00")


def feature(got: Parsed, payload: bytes) -> str:
    """Packets, units, random-access points, first and last time stamp, gaps; mean and deviation of the samples."""
    samples = np.frombuffer(payload, dtype=np.uint8)
    times = [u.pts for u in got.units if u.pts is not None]
    return f"packets={got.packets};units={len(got.units)};access={sum(u.random_access for u in got.units)};pts={min(times, default=-1)}-{max(times, default=-1)};gaps={len(got.gaps)};mean={samples.mean() if len(samples) else 0:.4f};std={samples.std() if len(samples) else 0:.4f}"


def store(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n_bytes, media binary): each whole text, padded, as a transport stream; null is empty.

    Equal texts give equal streams; repeated rows stay, other columns are left out; no
    documents, no rows.
    """

    def row(key, value):
        n, payload = padded(value)
        return key, n, write(payload)

    return map_rows(docs, [id_column, text], lambda: row, f"{typed(docs, id_column)},n_bytes bigint,media binary")


def units(media: DataFrame, column: str = "media", id_column: str = "doc_id") -> DataFrame:
    """A row for each elementary packet of each stream: (id, pid, stream_type, unit, pts, dts, random_access, byte_offset, whole, gaps, data).

    Null and empty streams, and streams without programme tables, give no rows; repeated
    streams give theirs again; other columns are left out.
    """
    told = f"{typed(media, id_column)},pid int,stream_type int,unit int,pts bigint,dts bigint,random_access boolean,byte_offset bigint,whole boolean,gaps int,data binary"
    schema = arrow_schema(told)

    def run(batches) -> Iterator:
        import pyarrow as pa

        for part in slices(batches):
            rows = []
            for key, stream in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                got = parse(stream or b"")
                rows += [(key, u.pid, got.streams[u.pid], i, u.pts, u.dts, u.random_access, u.offset, u.whole, len(got.gaps), u.data) for i, u in enumerate(got.units)]
            columns = zip(*rows, strict=True) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)

    return media.select(id_column, column).mapInArrow(run, told)


def digests(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """What ``store`` writes and ``parse`` reads back of every row, as digests and features.

    Equal texts give equal values; null is empty.  Other columns are left out, repeated rows
    stay; no documents, no rows.
    """

    def row(key, value):
        n, payload = padded(value)
        media = write(payload)
        got = parse(media)
        back = b"".join(u.data for u in got.units)
        return key, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(got, back)

    return map_rows(docs, [id_column, text], lambda: row, f"{typed(docs, id_column)},n_bytes bigint,payload_bytes bigint,payload_sha256 string,tail_crc32 bigint,media_bytes bigint,media_sha256 string,feature string")
