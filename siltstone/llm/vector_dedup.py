"""Embedding near-dedup by spherical-cap filters (Becker et al. 2016).

Filter directions are products of small random codes: after a random rotation a vector is
cut into blocks, each block has a codebook of random unit vectors, and every combination of
one code per block is a direction.  A vector is decoded to the list of all directions
with which its inner product exceeds a threshold, found by sorted block scores with pruning,
not by trying them all.  Vectors that share a direction are compared exactly.

The number of directions grows with the number of vectors so that a direction holds
about ``OCCUPANCY`` unrelated ones; list sizes grow only slowly.  Exact copies are
compared as one class.  A crowded direction is dealt into chunks and compared chunk by
chunk, in matrix products, without a row for each pair: a pair counts in the smallest
direction it shares, and a chunk pair gives link counts and a spanning forest.
"""

from __future__ import annotations

import functools
import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import connected_components, cut, importable

OCCUPANCY = 64
CHUNK = 1024
#: Expected number of directions shared by two vectors at the threshold; a pair is missed with a chance of about exp(-SHARED).
SHARED = 16.0
#: Independent rotations and codebooks; list lengths of one product code vary too much from vector to vector.
CODES = 32


@functools.lru_cache(maxsize=64)
def directions(dim: int, n: int, cosine: float) -> tuple[int, int, float]:
    """Blocks of a product code, codes of a block, and the wanted length of a vector's list."""
    tail = min(0.25, OCCUPANCY / max(n, 1))
    a = NormalDist().inv_cdf(1 - tail)
    # chance that the partner at this cosine also exceeds, by the bivariate normal law
    x = a + np.linspace(0, 8, 4001)
    weight = np.exp(-x * x / 2)
    spread = math.sqrt(max(1e-9, 1 - cosine * cosine))
    both = np.array([1 - NormalDist().cdf((a - cosine * v) / spread) for v in x])
    want = SHARED / float((weight * both).sum() / weight.sum())
    count = max(8.0, want / tail)
    blocks = 1 if dim < 4 else 2 if count < 4e6 or dim < 12 else 3
    return blocks, math.ceil((count / CODES) ** (1 / blocks)), want


def sent_as(dim: int, n: int, cosine: float) -> type:
    """The type of directions in the lists that are sent."""
    blocks, size, _ = directions(dim, n, cosine)
    return np.int32 if CODES * size**blocks < 1 << 31 else np.int64


class CapCode:
    """Random product code for vectors of one length; equal arguments give equal codes."""

    def __init__(self, dim: int, n: int, cosine: float, seed: int = 11):
        rng = np.random.default_rng([seed, dim])
        self.blocks, self.size, want = directions(dim, n, cosine)
        self.edges = np.linspace(0, dim, self.blocks + 1).astype(int)
        self.rotations, self.codes = [], []
        for _ in range(CODES):
            self.rotations.append(np.linalg.qr(rng.normal(size=(dim, dim)))[0])
            books = [rng.normal(size=(self.size, q - p)) for p, q in zip(self.edges, self.edges[1:])]
            self.codes.append([c / np.linalg.norm(c, axis=1, keepdims=True) * math.sqrt(c.shape[1] / dim) for c in books])
        # the threshold that gives random vectors lists of the wanted length
        trial = rng.normal(size=(256, dim))
        trial /= np.linalg.norm(trial, axis=1, keepdims=True)
        total = np.zeros((256, 256 * CODES))
        for k in range(CODES):
            for s in self.scores(trial, k):
                total[:, 256 * k : 256 * (k + 1)] += s[:, rng.integers(0, self.size, 256)]
        share = min(0.5, want / (CODES * self.size**self.blocks))
        top = np.sort(total, axis=None)
        self.threshold = float(top[max(0, int(len(top) * (1 - share)) - 1)])
        if share * len(top) < 50 and dim > 3:  # too far out for the trial: the tail of a random direction on the sphere
            t = np.linspace(0, 1, 20001)[:-1]
            tail = np.cumsum(((1 - t * t) ** ((dim - 3) / 2))[::-1])[::-1]
            self.threshold = float(t[np.searchsorted(-tail / (2 * tail[0]), -share)])

    def scores(self, unit: np.ndarray, k: int) -> list[np.ndarray]:
        turned = unit @ self.rotations[k]
        return [turned[:, p:q] @ c.T for p, q, c in zip(self.edges, self.edges[1:], self.codes[k])]

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (vector, direction) with an inner product above the threshold, by vector and then direction."""
        got = [self._decode(unit, k) for k in range(CODES)]
        row = np.concatenate([r for r, _ in got])
        code = np.concatenate([c + k * self.size**self.blocks for k, (_, c) in enumerate(got)])
        by = np.lexsort((code, row))
        return row[by], code[by]

    def _decode(self, unit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(unit)
        scores = self.scores(unit, k)
        best = [s.max(axis=1) for s in scores]
        row, code, sums = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
        for k, s in enumerate(scores):
            rest = sum(best[k + 1 :]) if k + 1 < len(scores) else np.zeros(n)
            order = np.argsort(-s, axis=1, kind="stable")
            ranked = -np.take_along_axis(s, order, axis=1)  # ascending
            # one sorted array for all rows: each row lies in a range of its own
            gap = 8.0
            flat = (ranked + gap * np.arange(n)[:, None]).ravel()
            bound = -(self.threshold - rest[row] - sums)
            stop = np.searchsorted(flat, np.clip(bound, -3.5, 3.5) + gap * row, "right") - row * self.size
            stop = np.clip(stop, 0, self.size)
            take = np.repeat(np.arange(len(row)), stop)
            rank = np.arange(len(take)) - np.repeat(np.cumsum(stop) - stop, stop)
            which = order[row[take], rank]
            row, code, sums = row[take], code[take] * self.size + which, sums[take] + s[row[take], which]
        return row, code


_codes: dict[tuple, CapCode] = {}


def code_for(dim: int, n: int, cosine: float) -> CapCode:
    key = (dim, n, cosine)
    if key not in _codes:
        if len(_codes) > 8:
            _codes.clear()
        _codes[key] = CapCode(*key)
    return _codes[key]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors by length: their rows and a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    size = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    first = np.cumsum(size) - size
    return {int(d): (rows := np.flatnonzero(size == d), flat[first[rows][:, None] + np.arange(d)]) for d in np.unique(size) if d}


def _decoder(n: int, cosine: float):
    names = ["_f", "_id", "_h", "_m", "_v", "_fs"]

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 2048):
                b = whole.slice(i, 2048)
                for dim, (rows, x) in _matrix(b.column(3)).items():
                    at, code = code_for(dim, n, cosine).decode(_unit(x))
                    # with a direction go the smaller ones of its vector's list
                    width = sent_as(dim, n, cosine)
                    sent, size = code.astype(width).tobytes(), np.dtype(width).itemsize
                    start = (np.searchsorted(at, np.arange(len(rows)))[at] * size).tolist()
                    lists = [sent[p : k * size] for k, p in enumerate(start)]
                    take = pa.array(rows[at])
                    yield pa.RecordBatch.from_arrays([pa.array(code), b.column(0).take(take), b.column(1).take(take), b.column(2).take(take), b.column(3).take(take), pa.array(lists, pa.binary())], names=names)

    return run


def _forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each index."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        new = label.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _compare(n: int, cosine: float):
    schema = pa.schema([("_id", pa.int64()), ("_h", pa.int64()), ("_links", pa.int64()), ("_root", pa.int64())])

    def pairs_of(width, chunk, lo, hi, unit, lists):
        """Index pairs at or above the cosine that have no smaller direction in common (``lists``)."""
        a = np.flatnonzero(chunk == lo)
        b = a if lo == hi else np.flatnonzero(chunk == hi)
        s = unit[a] @ unit[b].T
        ok = s >= cosine
        if lo == hi:
            ok = np.triu(ok, 1)
        if not ok.any():
            return np.zeros((0, 2), np.int64)
        ra, rb = np.flatnonzero(ok.any(1)), np.flatnonzero(ok.any(0))
        low = [np.frombuffer(lists[k], width) for k in np.concatenate((a[ra], b[rb]))]
        every = np.unique(np.concatenate(low))
        p, q = np.nonzero(ok[np.ix_(ra, rb)])
        earlier = np.zeros((len(ra), len(rb)), np.float32)
        for at in range(0, len(every), 2048):
            part = every[at : at + 2048]
            has = np.zeros((len(low), len(part)), np.float32)
            for k, x in enumerate(low):
                x = x[(x >= part[0]) & (x <= part[-1])]
                has[k, np.searchsorted(part, x)] = 1
            earlier += has[: len(ra)] @ has[len(ra) :].T
        new = earlier[p, q] == 0
        return np.stack([a[ra[p[new]]], b[rb[q[new]]]], 1)

    def run(t: pa.Table) -> pa.Table:
        f, lo, hi, chunk = (np.asarray(t[c].combine_chunks()) for c in ("_f", "_lo", "_hi", "_c"))
        ids, hs, mult = (np.asarray(t[c].combine_chunks()) for c in ("_id", "_h", "_m"))
        lists, vectors = t["_fs"].to_pylist(), t["_v"].combine_chunks()
        dims = np.asarray(pc.list_value_length(vectors))  # directions of another length have the same numbers
        order = np.lexsort((dims, hi, lo, f))
        cuts = np.flatnonzero((np.diff(f[order]) != 0) | (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0) | (np.diff(dims[order]) != 0)) + 1
        out = [[], [], [], []]
        for rows in np.split(order, cuts):
            if len(rows) < 2:
                continue
            rows = rows[np.lexsort((hs[rows], ids[rows]))]
            ((dim, (_, x)),) = _matrix(vectors.take(pa.array(rows))).items()
            k = rows[0]
            pairs = pairs_of(sent_as(dim, n, cosine), chunk[rows], lo[k], hi[k], _unit(x), [lists[r] for r in rows])
            if len(pairs):
                m = mult[rows]
                links = np.bincount(pairs[:, 0], m[pairs[:, 1]], len(rows)) + np.bincount(pairs[:, 1], m[pairs[:, 0]], len(rows))
                root, hit = _forest(pairs, len(rows)), np.flatnonzero(links)
                for c, v in zip(out, (ids[rows[hit]], hs[rows[hit]], links[hit].astype(np.int64), ids[rows[root[hit]]])):
                    c.append(v)
        return pa.Table.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], schema=schema)

    return run


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """Links vectors with a cosine (in double precision) of ``cosine`` or more.

    One row per input row: the id column, ``n_links`` (other vectors linked directly, exact copies
    counted each), ``component_id`` (smallest id reachable by links, itself included)
    and ``kept`` (it is its component's smallest).  Every link given is verified; a link at the
    threshold is missed with a chance of about exp(-SHARED), a closer one more rarely.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing and stay.  Only vectors of equal length link.  Rows with a null id link with nothing
    (component null, not kept).  Repeated rows count as vectors of their own.  An empty table
    gives an empty result; other columns are ignored.
    """
    importable(vectors.sparkSession)
    double = isinstance(vectors.schema[vector_col].dataType.elementType, T.DoubleType)
    kind = "double" if double else "float"
    rows = vectors.select(vectors[id_col].cast("bigint").alias("_id"), vectors[vector_col].cast(f"array<{kind}>").alias("_v"))
    fine = F.col("_id").isNotNull() & F.coalesce(F.size("_v") > 0, F.lit(False)) & ~F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("_v", lambda x: x != 0)
    valid = rows.where(fine)
    classes = cut(valid.groupBy("_v").agg(F.min("_id").alias("_id"), F.count("*").alias("_m")).select("_id", F.xxhash64("_v").alias("_h"), "_m", "_v"))
    n = classes.count()
    code_rows = classes.mapInArrow(_decoder(n, cosine), f"_f bigint, _id bigint, _h bigint, _m bigint, _v array<{kind}>, _fs binary")
    # crowded directions; the table is broadcast only if it is small
    crowded = cut(code_rows.groupBy("_f").count().where(F.col("count") > CHUNK).select("_f", F.ceil(F.col("count") / CHUNK).cast("int").alias("_n")))
    crowded = F.broadcast(crowded) if crowded.count() <= 50_000 else crowded
    dealt = code_rows.join(crowded, "_f", "left").withColumn("_n", F.coalesce("_n", F.lit(1))).withColumn("_c", F.pmod(F.xxhash64("_id", "_h"), F.col("_n")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_o")).select("*", F.least("_c", "_o").alias("_lo"), F.greatest("_c", "_o").alias("_hi")).drop("_o", "_n")
    # a task's group holds many directions, or one chunk pair of a crowded one
    groups = max(16, 1 << (n * 32 // 4096).bit_length())
    dealt = dealt.withColumn("_g", F.pmod(F.xxhash64("_f", "_lo", "_hi"), F.lit(groups)))
    found = cut(dealt.groupBy("_g").applyInArrow(_compare(n, cosine), "_id bigint, _h bigint, _links bigint, _root bigint"))
    links = found.groupBy("_id", "_h").agg(F.sum("_links").alias("_links"))
    parts = connected_components(found.select(F.col("_id").alias("a"), F.col("_root").alias("b")))
    known = classes.join(links, ["_id", "_h"], "left").join(parts.withColumnRenamed("node", "_id"), "_id", "left")
    known = known.select("_v", (F.coalesce("_links", F.lit(0)) + F.col("_m") - 1).alias("n_links"), F.coalesce("component", "_id").alias("component_id"))
    out = valid.join(known, "_v").select("_id", "n_links", "component_id").unionByName(rows.where(~fine).select("_id", F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component_id")))
    return out.select(F.col("_id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))


#: DuckDB SQL of the query: all pairs, so for small tables.  vec_id is assumed not to repeat.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""
