"""Hashed terms of texts, and bounded labelled samples of them.

Terms are lower-cased (A-Z) runs of letters, digits and non-ASCII bytes, and their
first 4, 5 and 6 bytes where the run is longer, so inflected forms share a term.  With
``shapes``, a few pseudo-terms tell bins of length, punctuation, capitals
and repetition.  All are hashed into ``1 << TERM_BITS`` numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import importable
from siltstone.llm.kernels import LOWER, U, chunks, flatten, mix, segments_to_rows, span_hashes

TERM_BITS = 22
_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[48:58] = _TERM_BYTE[97:123] = _TERM_BYTE[65:91] = _TERM_BYTE[128:] = True
PREFIXES = (4, 5, 6)


def _runs(buf: np.ndarray, offsets: np.ndarray):
    inside = np.concatenate((_TERM_BYTE[buf], [False]))
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    start, end = inside[:-1].copy(), inside[:-1].copy()
    start[1:] &= ~inside[:-2] | edge[1:-1]
    end &= ~inside[1:] | edge[1:]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _term(h: np.ndarray, salt: int) -> np.ndarray:
    return (mix(h + U(salt * 0x9E3779B97F4A7C15 % (1 << 64))) >> U(64 - TERM_BITS)).astype(np.uint32)


def batch_terms(column, shapes: bool = False, wanted: np.ndarray | None = None):
    """For bounded runs of texts: first and last text, then (text, term) pairs, each once, in order of text.

    ``wanted``: a flag for each term number; other terms are left out early.
    """
    whole, all_offsets = flatten(column)
    for i, j in chunks(all_offsets):
        raw, offsets = whole[all_offsets[i] : all_offsets[j]], all_offsets[i : j + 1] - all_offsets[i]
        texts, terms = [], []

        def add(text, term):
            if wanted is not None:
                hit = wanted[term]
                text, term = text[hit], term[hit]
            texts.append(text)
            terms.append(term)

        if len(raw):
            buf = LOWER[raw]
            starts, ends = _runs(buf, offsets)
            owner = segments_to_rows(np.diff(np.searchsorted(starts, offsets)))
            word = span_hashes(buf, starts, ends)
            add(owner, _term(word, 0))
            for n in PREFIXES:
                long = ends - starts > n
                add(owner[long], _term(span_hashes(buf, starts[long], starts[long] + n), n))
        if shapes:
            for k, values in enumerate(_shapes(raw, offsets)):
                add(np.arange(j - i), _term(values.astype(U) + U(1000 * (k + 1)), 99))
        pairs = np.unique((np.concatenate(texts).astype(U) << U(32)) | np.concatenate(terms).astype(U)) if texts else np.zeros(0, U)
        yield i, j, (pairs >> U(32)).astype(np.int64), (pairs & U(0xFFFFFFFF)).astype(np.uint32)


def _shapes(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    size = np.diff(offsets)

    def share(flags):
        total = np.concatenate(([0], np.cumsum(flags)))
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(size, 1)

    space = share((raw == 32) | (raw == 10))
    marks = share(~_TERM_BYTE[raw] & (raw != 32) & (raw != 10))
    capitals = share((raw >= 65) & (raw <= 90))
    lines = share(raw == 10)
    bins = lambda x, edges: np.searchsorted(np.asarray(edges), x)
    return [
        bins(size, [1, 50, 100, 200, 400, 800, 1600, 3200, 6400, 12800, 25600, 51200]),
        bins(marks, [0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5]),
        bins(capitals, [0.005, 0.01, 0.02, 0.05, 0.1, 0.3, 0.6]),
        bins(space, [0.05, 0.1, 0.15, 0.2, 0.25, 0.4]),
        bins(lines, [0.001, 0.002, 0.004, 0.01, 0.03, 0.1]),
    ]


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str, bound: int, shapes: bool = False) -> Sample:
    """Terms of at most ``bound`` labelled documents, on the driver.

    ``labels``: the label's id column and ``_y`` (int).  The documents with the lowest hashes of
    their ids are taken; their ids (at most ``bound`` rows) are what is broadcast.  Rows with a
    null id or label are left out; of repeated labels the largest counts.
    """
    importable(docs.sparkSession)
    known = labels.select(F.col(label_id_col).alias("_id"), "_y").where("_id is not null and _y is not null").groupBy("_id").agg(F.max("_y").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(bound)
    rows = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    rows = rows.join(F.broadcast(chosen), "_id")

    def run(batches):
        for b in batches:
            y, ids = b.column(b.schema.get_field_index("_y")), b.column(b.schema.get_field_index("_id"))
            for i, j, text, term in batch_terms(b.column(b.schema.get_field_index("_text")), shapes):
                edges = np.searchsorted(text, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([ids[i:j], y[i:j], pa.array([term[a:z].tobytes() for a, z in zip(edges, edges[1:])], pa.binary())], names=["_id", "_y", "_t"])

    got = rows.select("_id", "_y", "_text").mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _y int, _t binary")
    # one row an id, or repeated rows could pass the bound
    got = got.groupBy("_id").agg(F.min(F.struct("_y", "_t")).alias("_s")).select("_id", "_s.*").toArrow()
    order = np.asarray(pc.sort_indices(got["_id"]))
    data, offsets = flatten(got["_t"])
    return Sample(np.asarray(got["_y"].combine_chunks(), np.int64)[order] if len(order) else np.zeros(0, np.int64), order, offsets // 4, data.view(np.uint32))


@dataclass
class Sample:
    """Labels in order of ids; terms as they came (``order``: which of them belong to each label)."""

    y: np.ndarray
    order: np.ndarray
    first: np.ndarray
    terms: np.ndarray

    def select(self, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, index in ``among``) of all pairs whose term is in ``among``, by row."""
        known = np.full(1 << TERM_BITS, -1, np.int32)
        known[among] = np.arange(len(among))
        at = known[self.terms]
        hit = np.flatnonzero(at >= 0)
        owner = np.searchsorted(self.first, hit, "right") - 1
        rank = np.empty(len(self.order), np.int64)
        rank[self.order] = np.arange(len(self.order))
        row, feature = rank[owner], at[hit].astype(np.int64)
        by = np.lexsort((feature, row))
        return row[by], feature[by]

    def counts(self, labels: np.ndarray) -> np.ndarray:
        """How many of the documents at ``labels`` (flags, in order of ids) hold each term."""
        total, mine = np.zeros(1 << TERM_BITS, np.int32), np.zeros(len(self.order), bool)
        mine[self.order] = labels
        for a in range(0, len(mine), 1000):  # in parts, so the driver's memory stays small
            b = min(a + 1000, len(mine))
            part = self.terms[self.first[a] : self.first[b]]
            total += np.bincount(part[np.repeat(mine[a:b], np.diff(self.first[a : b + 1]))], minlength=len(total)).astype(np.int32)
        return total


def telling_terms(sample: Sample, classes: int, least: int = 3, g2: float = 15.0, most: int = 1024) -> np.ndarray:
    """Sorted terms that occur more or less often in some class, by a log-likelihood ratio of ``g2`` at least; the ``most`` clearest."""
    n = len(sample.y)
    every = sample.counts(np.ones(n, bool))
    found = np.flatnonzero(every >= least)
    df, best = every[found].astype(float), np.zeros(len(found))
    for c in range(classes):
        n1 = float(np.sum(sample.y == c))
        if not n1 or n1 == n:
            continue
        a = sample.counts(sample.y == c)[found]
        ratio = np.zeros(len(found))
        for seen, total, share in ((a, df, n1 / n), (df - a, df, 1 - n1 / n), (n1 - a, n - df, n1 / n), (n - n1 - df + a, n - df, 1 - n1 / n)):
            ok = seen > 0
            ratio[ok] += 2 * seen[ok] * np.log(seen[ok] / (total[ok] * share))
        best = np.maximum(best, ratio)
    ok = np.flatnonzero(best >= g2)
    return np.sort(found[ok[np.argsort(-best[ok], kind="stable")[:most]]])
