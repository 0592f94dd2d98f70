"""Vectorised text kernels on raw UTF-8 buffers.

A batch of texts is one byte array plus offsets.  Words are maximal runs of
bytes other than 0x20 and 0x09-0x0D; all of these are ASCII, so a cut never
splits a character.  Hashes are 64-bit polynomials (mod 2**64, with an odd base
and random byte values), normalised by position and finalised by a bijective
mix, so equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_WINDOW_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_tables: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64 bits."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64; kept for the next call up to 2M entries."""
    have = _tables.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 21:
            _tables[base] = have
    return have[:n]


def flatten(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes; a longer text has a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (one more at the end)."""
    if not len(buf):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    space = SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    start = ~space
    end = start.copy()
    start[1:] &= space[:-1] | edge[1:-1]
    end[:-1] &= space[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def prefix_hashes(buf: np.ndarray) -> np.ndarray:
    """What ``span_hashes`` needs of the bytes, for several sets of spans."""
    total = np.zeros(len(buf) + 1, U)
    np.cumsum(_BYTES[buf] * powers(_ODD, len(buf)), out=total[1:])
    return total


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte span."""
    total = prefix_hashes(buf) if total is None else total
    h = (total[ends] - total[starts]) * powers(_INVERSE, len(buf) + 1)[starts]
    return mix(h + (ends - starts).astype(U) * U(0xA24BAED4963EE407))


def window_hashes(h: np.ndarray, first: np.ndarray, width: int, lanes: int = 1) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` consecutive items that stay in one text.

    ``first``: index of each text's first item, one more at the end.  Returns one
    array a lane, the index of each window's first item, and for each text
    the index of its first window (one more at the end).
    """
    counts = np.maximum(np.diff(first) - width + 1, 0)
    base = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(base[-1]) + np.repeat(first[:-1] - base[:-1], counts)
    out = []
    for q in _WINDOW_BASES[:lanes]:
        total = np.zeros(len(h) + 1, U)
        np.cumsum(h * powers(q, len(h)), out=total[1:])
        out.append(mix((total[at + width] - total[at]) * powers(pow(q, -1, 1 << 64), len(h) + 1)[at]))
    return out, at, base


def segments_to_rows(counts: np.ndarray) -> np.ndarray:
    """0 repeated counts[0] times, 1 repeated counts[1] times, and so on."""
    return np.repeat(np.arange(len(counts)), counts)
