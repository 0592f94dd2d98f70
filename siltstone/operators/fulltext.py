"""Full-text index and search.

Postings (term, fragment, row, term count, positions) are made where a text is read, then range-partitioned by term,
fragment and row, so that a frequent term fills several pages, and sorted, so that a search
reads the row groups of its terms only.  Fragments the index doesn't cover are searched
by their text.  Scores are BM25 (Robertson & Zaragoza 2009).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import query_terms, terms
from siltstone.manifest import Fragment, Index, Snapshot
from siltstone.sources.scan import located
from siltstone.storage import Store

K1, B = 1.2, 0.75


#: Postings that one page holds, about.
PAGE_POSTINGS = 2_000_000
#: Texts that a Python worker is sent at a time, and bytes of them that it works on at once.
BATCH_TEXTS, CHUNK_BYTES = 256, 1 << 19
_POSTING = "term string, _fragment bigint, _row bigint, length int, tf int, positions array<int>"


def chunks(offsets: np.ndarray, limit: int):
    """Ranges of whole texts of at most ``limit`` bytes; a longer text has a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1))
        yield i, j
        i = j


def _inverted(batches):
    """Terms of each text once, with their count and ascending positions.  Texts come as terms joined by spaces, without a list's offsets."""
    for whole in batches:
        wide = np.asarray(pc.binary_length(whole.column(2)).fill_null(0), np.int64)
        for i, j in chunks(np.concatenate(([0], np.cumsum(wide))), CHUNK_BYTES):
            b = whole.slice(i, j - i).filter(pa.array(wide[i:j] > 0))
            if not b.num_rows:
                continue
            split = pc.split_pattern(b.column(2), " ")
            size = np.asarray(split.value_lengths(), np.int64)
            words = split.flatten().dictionary_encode()
            code, row = np.asarray(words.indices, np.int64), np.repeat(np.arange(len(size)), size)
            position = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            order = np.lexsort((code, row))  # stable: positions stay in order
            code, row = code[order], row[order]
            first = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (row[1:] != row[:-1]))))
            ends = np.append(first, len(code)).astype(np.int32)
            at = pa.array(row[first])
            places = pa.ListArray.from_arrays(pa.array(ends), pa.array(position[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([words.dictionary.take(pa.array(code[first])), b.column(0).take(at), b.column(1).take(at), pa.array(size.astype(np.int32)).take(at), pa.array(np.diff(ends)), places], names=["term", "_fragment", "_row", "length", "tf", "positions"])


def _words(rows: DataFrame, column: str, options: dict):
    text = F.col(f"`{column}`")
    if rows.schema[column].dataType.typeName() == "array":
        text = F.array_join(text, " ")
    return terms(text, options.get("lower_case", True), options.get("remove_stop_words", False))


def postings(rows: DataFrame, column: str, options: dict, wanted: Sequence[str] | None = None) -> DataFrame:
    """One row a term and text; with ``wanted`` only of texts that hold one of these terms."""
    words = rows.select("_fragment", "_row", _words(rows, column, options).alias("_w"))
    if wanted is not None:
        words = words.where(F.arrays_overlap("_w", F.array(*map(F.lit, wanted))) if wanted else F.lit(False))
    return words.select("_fragment", "_row", F.array_join("_w", " ").alias("_w")).mapInArrow(_inverted, _POSTING)


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs started within send few texts at a time to Python: a worker's memory follows a batch's bytes, and texts may be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_TEXTS))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def build(staged: DataFrame, pages: int) -> DataFrame:
    return staged.repartitionByRange(pages, "term", "_fragment", "_row").sortWithinPartitions("term", "_fragment", "_row")


def _phrases(query: str) -> tuple[list[str], list[str]]:
    """Quoted phrases, and the rest."""
    return re.findall(r'"([^"]+)"', query), [re.sub(r'"[^"]*"', " ", query)]


def search(spark: SparkSession, store: Store, snapshot: Snapshot, query: str | dict, column: str | None = None, fragments: Sequence[Fragment] | None = None) -> DataFrame:
    """Rows that match, with ``_rowid`` and ``_score``; rows without a hit are left out.

    A row matches if it holds any of the words and all quoted phrases. ``query``: text, or {"query", "columns": [name],
    "operator": "or" or "and"}.
    """
    operator = "or"
    if isinstance(query, dict):
        column = column or (query.get("columns") or [None])[0]
        operator, query = query.get("operator", "or").lower(), query["query"]
    found = [i for i in snapshot.indices if i.kind == "Inverted" and (column is None or i.column == column)]
    if not found and column is None:
        raise ValueError("the table has no full-text index; name a column to search without one")
    index: Index | None = found[0] if found else None
    column = column or index.column
    if column not in snapshot.schema.names:
        raise ValueError(f"Column '{column}' not found")
    options = dict(index.options) if index else {}
    options_of = {"lower_case": options.get("lower_case", True), "remove_stop_words": options.get("remove_stop_words", False)}
    fragments = list(snapshot.fragments if fragments is None else fragments)
    phrases, rest = _phrases(query)
    phrase_terms = [query_terms(p, **options_of) for p in phrases]
    loose = query_terms(rest[0], **options_of)
    wanted = sorted({*loose, *(t for p in phrase_terms for t in p)})
    covered = set(index.fragments) if index else set()
    positional = any(len(p) > 1 for p in phrase_terms)
    indexed = index is not None and (not positional or options.get("with_position", False))
    parts = []
    inside, outside = [f for f in fragments if indexed and f.id in covered], [f for f in fragments if not (indexed and f.id in covered)]
    fields = ["term", "_fragment", "_row", "length", "tf", *(["positions"] if positional else [])]
    pages = [p["path"] for p in index.files if "min" not in p or any(p["min"] <= t <= p["max"] for t in wanted)] if inside else []
    if pages:
        entries = spark.read.options(**store.options).parquet(*[store.path(p) for p in pages]).where(F.col("term").isin(wanted))
        if len(inside) < len(covered):
            entries = entries.where(F.col("_fragment").isin([f.id for f in inside]))
        parts.append(entries.select(*fields, F.lit(True).alias("_known")))
    if outside:
        rows = located(spark, store, snapshot, outside)
        parts.append(postings(rows, column, options_of, wanted).where(F.col("term").isin(wanted)).select(*fields, F.lit(not indexed).alias("_known")))
    hits = parts[0] if parts else spark.createDataFrame([], "term string, _fragment bigint, _row bigint, length int, tf int, _known boolean" + (", positions array<int>" if positional else ""))
    for p in parts[1:]:
        hits = hits.unionByName(p)
    # corpus figures all come from the indexed part; without an index, from the rows searched
    if indexed:
        n, length = options["documents"], options["length"]
    else:
        n = sum(f.live for f in fragments)
        searched = located(spark, store, snapshot, fragments)
        length = searched.agg(F.sum(F.size(_words(searched, column, options_of)))).first()[0] or 0
    mean = F.lit(max(float(length) / max(n, 1), 1e-9))
    df = hits.groupBy("term").agg(F.sum(F.col("_known").cast("int")).alias("_df"))  # one row a query word
    idf = F.log(1 + (F.lit(float(n)) - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    weight = F.greatest(idf, F.lit(0.0)) * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / mean))
    scored = hits.join(F.broadcast(df), "term").withColumn("_w", weight)
    per = scored.groupBy("_fragment", "_row").agg(F.sum("_w").alias("_score"), F.collect_set("term").alias("_terms"), *([F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("_at")] if positional else []))
    if loose:
        per = per.where(F.arrays_overlap("_terms", F.array(*map(F.lit, loose)))) if operator == "or" else per.where(F.forall(F.array(*map(F.lit, loose)), lambda t: F.array_contains("_terms", t)))
    for p in phrase_terms:
        per = per.where(F.forall(F.array(*map(F.lit, p)), lambda t: F.array_contains("_terms", t))) if p else per.where(F.lit(False))
        if len(p) > 1:
            follows = None
            for k, t in enumerate(p):
                one = F.transform(F.col("_at")[t], _back(k))
                follows = one if follows is None else F.array_intersect(follows, one)
            per = per.where(F.size(follows) > 0)
    per = per.select("_fragment", "_row", "_score")
    if len(fragments) > 1:  # only fragments with a hit are read
        hit = {r[0] for r in per.select("_fragment").distinct().collect()}  # fragment ids
        fragments = [f for f in fragments if f.id in hit]
    out = located(spark, store, snapshot, fragments).join(per, ["_fragment", "_row"])
    return out.select(*snapshot.schema.names, F.shiftleft("_fragment", 32).bitwiseOR(F.col("_row")).alias("_rowid"), "_score")


def _back(k: int):
    return lambda x: x - k
