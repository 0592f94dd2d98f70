"""Slices: bounded groups of documents that exchange packed hashes.

A slice is a few MB of whole documents, dealt by a hash of (id, text), so neither a
hot source nor exact copies gather in one; rows that repeat both, and are too many for a slice, are dealt in turn.
A slice sends its hashes, sorted and packed, to blocks (ranges of the hash); a block sees every slice's
share, counts, and answers each slice with what concerns it.  Within a slice a
hash is sent once or as often as asked, so a hot key costs a block at most
one entry a slice and document, and no task gathers a key's documents.

Messages are pairs of a slice and a block.  Their number must not outgrow what they carry, so a block takes four
slices' share, and slices grow with the root of the input as soon as a message would else carry
fewer than about 64 hashes (see ``sizes``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.kernels import U

SLICE_BYTES = 4 << 20
#: Slices of a block's share.
FAN_IN = 4
#: Text bytes behind a message, at least: some 64 words.
MESSAGE_BYTES = 384


@dataclass(frozen=True)
class Plan:
    slices: int  # by hash
    more: int  # for rows that repeat
    blocks: int
    each: float


def sizes(total: int, slice_bytes: int = SLICE_BYTES) -> tuple[int, int, float]:
    """Slices, blocks (powers of two from 16) and bytes of a slice for so many bytes of text."""
    each = max(float(slice_bytes), (MESSAGE_BYTES * total / FAN_IN) ** 0.5)
    n = 16
    while n * each < total:
        n *= 2
    return n, max(16, n // FAN_IN), each


def _key():
    return F.xxhash64("_id", "_text")


def plan(docs: DataFrame, slice_bytes: int | None = None) -> Plan:
    """How a view with ``_id`` and ``_text`` is dealt; one small row reaches the driver."""
    size = F.octet_length("_text") + 16
    alike = docs.groupBy(_key().alias("_k")).agg(F.sum(size).alias("_b"))
    slices, blocks, each = sizes(alike.agg(F.sum("_b")).first()[0] or 0, slice_bytes or SLICE_BYTES)
    crowd = alike.where(F.col("_b") > each / 2).agg(F.sum("_b")).first()[0] or 0
    return Plan(slices, int(-(-crowd // each)), blocks, each)


def deal(docs: DataFrame, plan: Plan) -> DataFrame:
    """Adds ``_s``, the slice of each row."""
    by_hash = F.pmod(_key(), F.lit(plan.slices)).cast("int")
    if not plan.more:
        return docs.withColumn("_s", by_hash)
    # each of these keys has half a slice, so there are fewer than twice as many as slices
    crowd = docs.groupBy(_key().alias("_k")).agg(F.sum(F.octet_length("_text") + 16).alias("_b")).where(F.col("_b") > plan.each / 2).select("_k")
    keyed = docs.withColumn("_k", _key())
    plain = keyed.join(F.broadcast(crowd), "_k", "left_anti").drop("_k").withColumn("_s", by_hash)
    # in turn, in an order that Spark makes repeatable
    rest = keyed.join(F.broadcast(crowd), "_k", "left_semi").drop("_k").repartition(plan.more).withColumn("_s", (F.lit(plan.slices) + F.pmod(F.spark_partition_id(), F.lit(plan.more))).cast("int"))
    return plain.unionByName(rest)


def pack(low: np.ndarray, bits: int) -> bytes:
    """Sorted values of ``bits`` bits: the ``width`` lowest bytes of each, and counts of the values by their other bits.

    The width is the one that takes least room, so few values have a small header and many have short entries.
    """
    counter = np.uint16 if len(low) < 65536 else np.uint32
    width = min((w for w in range(1, 9) if bits - 8 * w <= 16), key=lambda w: (counter().itemsize << max(0, bits - 8 * w)) + w * len(low))
    n = np.bincount((low >> U(8 * width)).astype(np.int64), minlength=1 << (bits - 8 * width)) if bits > 8 * width else np.array([len(low)])
    head = bytes([width | 16 * (counter is np.uint32)]) + n.astype(counter).tobytes()
    return head + np.ascontiguousarray(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(data: bytes, bits: int) -> np.ndarray:
    width, counter = data[0] & 15, np.uint32 if data[0] & 16 else np.uint16
    kinds = 1 << max(0, bits - 8 * width)
    n = np.frombuffer(data, counter, kinds, 1)
    raw = np.frombuffer(data, np.uint8, offset=1 + n.nbytes).reshape(-1, width)
    low = np.zeros((len(raw), 8), np.uint8)
    low[:, :width] = raw
    low = low.view("<u8").ravel()
    return low | np.repeat(np.arange(kinds, dtype=U) << U(8 * width), n) if kinds > 1 else low


def recurring(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values that stand at least twice in all arrays together, ascending, and how often."""
    every = np.sort(np.concatenate(values)) if values else np.zeros(0, U)
    edges = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1], [True]))) if len(every) else np.zeros(1, np.int64)
    n = np.diff(edges)
    return every[edges[:-1][n > 1]], n[n > 1]


def send(h: np.ndarray, blocks: int, bits: int) -> list[tuple[int, bytes]]:
    """Messages of sorted hashes: the highest bits name the block, the next ``bits`` are packed."""
    log = blocks.bit_length() - 1
    if not len(h):
        return []
    cuts = np.searchsorted(h, np.arange(1, blocks, dtype=U) << U(64 - log)) if log else np.zeros(0, np.int64)
    edges = np.concatenate(([0], cuts, [len(h)]))
    low = (h << U(log)) >> U(64 - bits)
    return [(int(b), pack(low[edges[b] : edges[b + 1]], bits)) for b in np.flatnonzero(np.diff(edges))]


def whole(block: int, low: np.ndarray, blocks: int, bits: int) -> np.ndarray:
    """The sent bits of hashes, as the lowest bits of a number."""
    return (U(block) << U(bits)) | low


def shorten(h: np.ndarray, blocks: int, bits: int) -> np.ndarray:
    """The bits that ``send`` sends of a hash."""
    return h >> U(64 - bits - (blocks.bit_length() - 1))


def at_most(sorted_h: np.ndarray, k: int) -> np.ndarray:
    """Keeps up to ``k`` of each run of equal values."""
    if len(sorted_h) <= k:
        return sorted_h
    keep = np.ones(len(sorted_h), bool)
    keep[k:] = sorted_h[k:] != sorted_h[:-k]
    return sorted_h[keep]


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def table_of(schema: pa.Schema, columns: list) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
