"""Substring dedup with a count-min prefilter.

Every run of ``width`` consecutive words is a window.  Each slice of documents
builds a sparse count-min sketch of its windows (``depth`` rows; a row is 2**26
cells for each block, so its width grows with the corpus); the sketches are merged by adding the counters of each cell range.
Counters never underestimate, so a window whose counter is below two in any
row occurs once.  A second pass groups only the remaining windows, by 96 bits of
hash, and tells each slice which of its windows truly repeat.  A third pass
merges the covered positions and rebuilds the texts.  The text is shuffled once
(the three passes reuse that exchange); what moves besides is two to three bytes a
window and sketch row, and 12 bytes for each window that may repeat and 8 for each that does.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import slices as S
from siltstone.llm.common import arrow_type, view
from siltstone.llm.kernels import U, chunks, flatten, mix, segments_to_rows, span_hashes, window_hashes, words

_BITS = 26
_MESSAGE = pa.schema([("_s", pa.int32()), ("_d", pa.int32()), ("_b", pa.int32()), ("_h", pa.binary())])
_MESSAGE_DDL = "_s int, _d int, _b int, _h binary"
#: 96 bits tell windows apart.
_PAIR = np.dtype([("a", "<u8"), ("b", "<u4")])


def _windows(texts, width: int, lanes: int):
    """For each bounded run of texts: buffer, word spans, word index of each text, window hashes and their places."""
    buf, offsets = flatten(texts)
    for i, j in chunks(offsets):
        part, at = buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words(part, at)
        hashes, place, base = window_hashes(span_hashes(part, starts, ends), first, width, lanes)
        yield i, j, part, starts, ends, first, hashes, place, base


def _cells(h: np.ndarray, row: int) -> np.ndarray:
    return mix(h + U(row * 0x9E3779B97F4A7C15 % (1 << 64)))


def _sketch(width: int, depth: int, blocks: int):
    def run(t: pa.Table) -> pa.Table:
        got = [w[6][0] for w in _windows(t["_text"], width, 1)]
        h = np.concatenate(got) if got else np.zeros(0, U)
        out = []
        if len(h):
            s = t["_s"][0].as_py()
            for d in range(depth):
                # a counter of two says all that is asked, so no slice sends more than two for a cell
                cells = S.at_most(np.sort(_cells(h, d) >> U(64 - _BITS - blocks.bit_length() + 1)), 2)
                cells <<= U(64 - _BITS - blocks.bit_length() + 1)
                out += [(s, d, b, x) for b, x in S.send(cells, blocks, _BITS)]
        return S.table_of(_MESSAGE, list(zip(*out)) if out else [[]] * 4)

    return run


def _merge_cells(t: pa.Table) -> pa.Table:
    """Adds the partition sketches over one cell range; answers each slice with its cells of two or more."""
    s, d, b = t["_s"].to_pylist(), t["_d"][0].as_py(), t["_b"][0].as_py()
    low = [S.unpack(x.as_py(), _BITS) for x in t["_h"]]
    full, _ = S.recurring(low)
    out = []
    for k, x in zip(s, low):
        hot = S.at_most(x[S.member(x, full)], 1)
        if len(hot):
            out.append((k, d, b, S.pack(hot, _BITS)))
    return S.table_of(_MESSAGE, list(zip(*out)) if out else [[]] * 4)


def _candidates(width: int, depth: int, blocks: int):
    def run(docs: pa.Table, hot: pa.Table) -> pa.Table:
        out = []
        if docs.num_rows and hot.num_rows:
            rows = [[] for _ in range(depth)]
            for d, b, x in zip(hot["_d"].to_pylist(), hot["_b"].to_pylist(), hot["_h"].to_pylist()):
                rows[d].append(S.whole(b, S.unpack(x, _BITS), blocks, _BITS))
            rows = [np.sort(np.concatenate(r)) if r else np.zeros(0, U) for r in rows]
            a, b2 = [], []
            for w in _windows(docs["_text"], width, 2):
                h1, h2 = w[6]
                ok = np.ones(len(h1), bool)
                for d in range(depth):
                    at = np.flatnonzero(ok)
                    ok[at] = S.member(S.shorten(_cells(h1[at], d), blocks, _BITS), rows[d])
                a.append(h1[ok])
                b2.append(h2[ok])
            pairs = _sorted_pairs(np.concatenate(a), np.concatenate(b2)) if a else np.zeros(0, _PAIR)
            keep = np.ones(len(pairs), bool)
            keep[2:] = pairs[2:] != pairs[:-2]
            pairs = pairs[keep]
            block = (pairs["a"] >> U(64 - blocks.bit_length() + 1)).astype(np.int64)
            edges = np.searchsorted(block, np.arange(blocks + 1))
            s = docs["_s"][0].as_py()
            out = [(s, 0, int(k), pairs[edges[k] : edges[k + 1]].tobytes()) for k in np.flatnonzero(np.diff(edges))]
        return S.table_of(_MESSAGE, list(zip(*out)) if out else [[]] * 4)

    return run


def _sorted_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    order = np.lexsort((b, a))
    pairs = np.empty(len(a), _PAIR)
    pairs["a"], pairs["b"] = a[order], b[order]
    return pairs


def _group_exactly(t: pa.Table) -> pa.Table:
    """Counts the windows of one hash range; answers each slice with those that start twice or more."""
    s, b = t["_s"].to_pylist(), t["_b"][0].as_py()
    each = [np.frombuffer(x.as_py(), _PAIR) for x in t["_h"]]
    every, source = np.concatenate(each), segments_to_rows(np.array([len(x) for x in each]))
    order = np.lexsort((source, every["b"], every["a"]))
    every, source = every[order], source[order]
    same = every[1:] == every[:-1]
    again = np.zeros(len(every), bool)
    again[1:] |= same
    again[:-1] |= same
    every, source = every[again], source[again]
    order = np.argsort(source, kind="stable")
    every, source = every[order], source[order]
    edges = np.searchsorted(source, np.arange(len(s) + 1))
    # a slice knows its own windows' second halves, so the answer names the first ones only
    out = [(s[k], 0, b, every["a"][edges[k] : edges[k + 1]].tobytes()) for k in np.flatnonzero(np.diff(edges))]
    return S.table_of(_MESSAGE, list(zip(*out)) if out else [[]] * 4)


def _rebuild(width: int, id_type: pa.DataType):
    schema = pa.schema([("_id", id_type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))])

    def run(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        ids = docs["_id"].combine_chunks() if docs["_id"].num_chunks != 1 else docs["_id"].chunk(0)
        found = [np.frombuffer(x.as_py(), "<u8") for x in repeated["_h"]]
        found = np.unique(np.concatenate(found)) if found else np.zeros(0, U)
        n_words, n_removed, kept, spans = [], [], [], []
        for i, j, part, starts, ends, first, (h,), place, _ in _windows(docs["_text"], width, 1):
            gone = np.zeros(len(starts) + 1, np.int64)
            hit = place[S.member(h, found)]
            np.add.at(gone, hit, 1)
            np.add.at(gone, hit + width, -1)
            covered = np.cumsum(gone[:-1]) > 0
            total = np.concatenate(([0], np.cumsum(covered)))
            raw = part.tobytes()
            for k in range(j - i):
                lo, hi = int(first[k]), int(first[k + 1])
                lost = int(total[hi] - total[lo])
                n_words.append(hi - lo)
                n_removed.append(lost)
                text = raw[starts[lo] : ends[hi - 1]].split() if hi > lo else []
                if lost:
                    flags = covered[lo:hi]
                    step = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
                    spans.append(np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], 1).tolist())
                    text = compress(text, (~flags).tolist())
                else:
                    spans.append([])
                kept.append(b" ".join(text).decode("utf-8", "replace"))
        return pa.Table.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, schema.field("spans").type)], schema=schema)

    return run


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35, depth: int = 2) -> DataFrame:
    """Removes each word covered by a window of ``width`` words that also starts elsewhere.

    Words are runs of characters other than 0x20 and 0x09-0x0D, compared as they
    are.  Windows are judged on the input, in this or another row, so all copies
    of a repeated passage go.  Returns one row per input row: the id column, ``n_words``,
    ``n_removed``, ``kept`` (kept words joined by one space) and ``spans`` (removed
    word ranges, [from, to)).

    Null text: as empty.  Null ids are kept as ids.  Texts of fewer than ``width``
    words have no window and stay whole.  Repeated rows count as separate documents,
    so both lose their windows.  An empty table gives an empty result; other columns
    of the table are ignored.
    """
    rows = view(docs, id_col, text_col)
    plan = S.plan(rows)
    dealt, n = S.deal(rows, plan), plan.blocks
    id_type = arrow_type(dealt, "_id")
    sketches = dealt.groupBy("_s").applyInArrow(_sketch(width, depth, n), _MESSAGE_DDL)
    hot = sketches.groupBy("_d", "_b").applyInArrow(_merge_cells, _MESSAGE_DDL)
    maybe = dealt.groupBy("_s").cogroup(hot.groupBy("_s")).applyInArrow(_candidates(width, depth, n), _MESSAGE_DDL)
    repeated = maybe.groupBy("_b").applyInArrow(_group_exactly, _MESSAGE_DDL)
    out = dealt.groupBy("_s").cogroup(repeated.groupBy("_s")).applyInArrow(_rebuild(width, id_type), f"_id {dealt.schema['_id'].dataType.simpleString()}, n_words bigint, n_removed bigint, kept string, spans array<array<bigint>>")
    return out.withColumnRenamed("_id", id_col)


#: DuckDB SQL of the query, which compares the words themselves.  doc_id is assumed not to repeat.
SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, p, array_to_string(ws[p : p + 34], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS p FROM w)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY win) AS n FROM s) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p + d AS p FROM r, (SELECT unnest(range(0, 35)) AS d)),
e AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM e ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
