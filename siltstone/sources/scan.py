"""Scans: a snapshot's fragments as one DataFrame.

The driver chooses files (fragment ids, statistics, B-tree pages); everything after
that is Spark's: vectorised Parquet reading, pushdown, pruning, AQE.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.manifest import Fragment, Snapshot, load
from siltstone.namespace import Namespace, resolve
from siltstone.plans.prune import may_match, ranges
from siltstone.storage import Store

#: Deleted row addresses are broadcast up to this number, known from the manifest.
BROADCAST_DELETIONS = 1_000_000


#: Scanner options about speed only.
HINTS = ("batch_size", "batch_readahead", "fragment_readahead", "io_buffer_size", "late_materialization", "scan_in_order", "use_stats")


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def paths(store: Store, fragments: Sequence[Fragment]) -> list[str]:
    """What Spark is to read: a folder where all its files are asked for, as many single paths take long to check and list."""
    names: dict[str, set[str]] = {}
    for f in fragments:
        folder, _, name = f.path.rpartition("/")
        names.setdefault(folder, set()).add(name)
    out = []
    for folder, wanted in names.items():
        if len(wanted) > 1 and {n for n, _ in store.list(folder) if not n.startswith((".", "_"))} == wanted:
            out.append(store.path(folder))
        else:
            out += [store.path(f"{folder}/{n}") for n in sorted(wanted)]
    return out


def _files(spark: SparkSession, store: Store, snapshot: Snapshot, fragments: Sequence[Fragment]) -> DataFrame:
    # files without a later column read it as null
    return spark.read.schema(snapshot.schema).options(**store.options).parquet(*paths(store, fragments))


def located(spark: SparkSession, store: Store, snapshot: Snapshot, fragments: Sequence[Fragment], deleted: bool = False) -> DataFrame:
    """Rows with ``_fragment`` and ``_row`` (position in the file); also deleted rows, if asked."""
    if not fragments:
        return empty(spark, snapshot.schema).withColumns({"_fragment": F.lit(0).cast("bigint"), "_row": F.lit(0).cast("bigint")})
    names = spark.createDataFrame([(f.place, f.id) for f in fragments], "_file string, _fragment bigint")
    rows = _files(spark, store, snapshot, fragments).select("*", F.substring_index("_metadata.file_path", "/", -2).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    rows = rows.join(F.broadcast(names), "_file").drop("_file")  # one row a fragment
    return rows if deleted else without_deleted(rows, spark, store, fragments)


def without_deleted(rows: DataFrame, spark: SparkSession, store: Store, fragments: Sequence[Fragment]) -> DataFrame:
    folders = sorted({d for f in fragments for d in f.deletions})
    if not folders:
        return rows
    gone = spark.read.schema("_fragment bigint, _row bigint").options(**store.options).parquet(*[store.path(d) for d in folders])
    small = sum(f.deleted for f in fragments) <= BROADCAST_DELETIONS
    gone = gone.where(F.col("_fragment").isin([f.id for f in fragments if f.deleted])) if len(fragments) <= 1000 else gone
    return rows.join(F.broadcast(gone) if small else gone, ["_fragment", "_row"], "left_anti")


def scan(spark: SparkSession, store: Store, snapshot: Snapshot, fragments: Sequence[Fragment], row_ids: bool = False) -> DataFrame:
    """Live rows of the fragments; ``_rowid`` is fragment id << 32 | row.

    Only fragments with deletions pay for finding their rows' addresses.
    """
    columns = snapshot.schema.names
    if row_ids:
        return located(spark, store, snapshot, fragments).withColumn("_rowid", F.shiftleft("_fragment", 32).bitwiseOR(F.col("_row"))).select(*columns, "_rowid")
    clean = [f for f in fragments if not f.deleted]
    worn = [f for f in fragments if f.deleted]
    parts = []
    if clean:
        parts.append(_files(spark, store, snapshot, clean))
    if worn:
        parts.append(located(spark, store, snapshot, worn).select(*columns))
    if not parts:
        return empty(spark, snapshot.schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def choose(spark: SparkSession, store: Store, snapshot: Snapshot, filter: str | None, fragment_ids: Sequence[int] | None = None, use_indices: bool = True) -> list[Fragment]:
    """Fragments that may hold rows for the filter. Unknown ids are passed over; an empty list means all."""
    fragments = list(snapshot.fragments)
    if fragment_ids:
        wanted = set(fragment_ids)
        fragments = [f for f in fragments if f.id in wanted]
    bounds = ranges(spark, filter)
    names = {c.lower(): c for c in snapshot.schema.names}
    bounds = {names[c.lower()]: r for c, r in bounds.items() if c.lower() in names}
    fragments = [f for f in fragments if may_match(f, bounds)]
    if use_indices:
        from siltstone.operators.btree import fragments_with

        for index in snapshot.indices:
            r = bounds.get(index.column)
            if index.kind == "BTree" and r is not None and fragments and all(isinstance(v, str) == isinstance(snapshot.schema[index.column].dataType, T.StringType) for v in (r.low, r.high) if v is not None):
                hits = fragments_with(spark, store, index, r)
                covered = set(index.fragments)
                fragments = [f for f in fragments if f.id in hits or f.id not in covered]
    return fragments


def _nearest(rows: DataFrame, column: str, q: Sequence[float], k: int = 10, metric: str = "l2") -> DataFrame:
    """The k rows with the least distance (squared for l2, 1 - similarity for the others), each task keeping its k best.

    Null vectors, vectors of another length and distances that are no number are never near.
    """
    if k <= 0 or metric not in ("l2", "cosine", "dot"):
        raise ValueError(f"nearest needs k > 0 and a metric of l2, cosine or dot, not {k} and {metric!r}")
    q = [float(x) for x in q]
    v, total = F.col(f"`{column}`"), lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    point = F.array(*map(F.lit, q))
    product = total(F.zip_with(v, point, lambda x, y: x.cast("double") * y))
    if metric == "l2":
        away = total(F.zip_with(v, point, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)))
    elif metric == "dot":
        away = 1 - product
    else:
        norm = F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
        away = 1 - product / (norm * float(sum(x * x for x in q) ** 0.5))
    out = rows.where(F.size(v) == len(q)).withColumn("_distance", away)
    return out.where(F.col("_distance").isNotNull() & ~F.isnan("_distance")).orderBy("_distance").limit(k)


def read_table(
    uri: str | None = None,
    *,
    spark: SparkSession | None = None,
    namespace: Namespace | None = None,
    table_id: list[str] | None = None,
    columns: Sequence[str] | None = None,
    filter: str | None = None,
    storage_options: dict[str, Any] | None = None,
    scanner_options: dict[str, Any] | None = None,
    dataset_options: dict[str, Any] | None = None,
    fragment_ids: Sequence[int] | None = None,
    concurrency: int | None = None,
    override_num_blocks: int | None = None,
) -> DataFrame:
    """A table, or one of its versions, as a DataFrame.

    ``columns``: in this order. ``filter``: Spark SQL over all columns, projected or not.
    ``fragment_ids``: only these (unknown ones are passed over; empty: all).
    ``dataset_options``: ``version``. ``scanner_options``: ``columns``, ``filter``, ``with_row_id``, ``limit``,
    ``offset``, ``order_by`` (columns), ``full_text_query``, ``use_scalar_index``, and ``nearest``: {"column", "q", "k" (10),
    "metric" ("l2", "cosine", "dot")}, the k rows that meet the filter and lie nearest to the vector q, with ``_distance``.
    ``HINTS`` such as ``batch_size`` are Spark's own to choose; other options are an error.
    ``override_num_blocks``: number of partitions; ``concurrency``: at most so many.
    A missing table fails here, not at the first action.
    """
    spark = spark or SparkSession.builder.getOrCreate()
    uri, options = resolve(uri, namespace, table_id, storage_options)
    store = Store(uri, spark, options)
    dataset, scanner = dict(dataset_options or {}), dict(scanner_options or {})
    snapshot = load(store, dataset.pop("version", None))
    columns, filter = columns if columns is not None else scanner.pop("columns", None), filter if filter is not None else scanner.pop("filter", None)
    row_ids, query = scanner.pop("with_row_id", False), scanner.pop("full_text_query", None)
    limit, offset, order = scanner.pop("limit", None), scanner.pop("offset", None), scanner.pop("order_by", None)
    fragments = choose(spark, store, snapshot, filter, fragment_ids, scanner.pop("use_scalar_index", True))
    nearest = scanner.pop("nearest", None)
    for k in HINTS:  # how fast, not what
        scanner.pop(k, None)
    dataset.pop("block_size", None)
    if scanner:  # it could change the result
        raise ValueError(f"scanner options {sorted(scanner)} are unknown")
    for k in dataset:
        warnings.warn(f"option {k!r} has no meaning here", stacklevel=2)
    unknown = [c for c in columns or () if c not in snapshot.schema.names and not (row_ids and c == "_rowid") and not (nearest is not None and c == "_distance")]
    if unknown:
        raise ValueError(f"columns {unknown} not found; the table has {snapshot.schema.names}")
    if query is not None:
        from siltstone.operators.fulltext import search

        out = search(spark, store, snapshot, query, fragments=fragments)
        if not row_ids:
            out = out.drop("_rowid")
        out = out.drop("_score")
    else:
        out = scan(spark, store, snapshot, fragments, row_ids)
    if filter:
        out = out.where(F.expr(filter))
    if nearest is not None:
        out = _nearest(out, **nearest)
    if order:
        out = out.orderBy(*order)
    if offset:
        out = out.offset(int(offset))
    if limit is not None:
        out = out.limit(int(limit))
    if columns is not None:
        out = out.select(*[F.col(f"`{c}`") for c in columns], *(["_rowid"] if row_ids and "_rowid" not in columns else []), *(["_distance"] if nearest is not None and "_distance" not in columns else []))
    if override_num_blocks:
        out = out.repartition(override_num_blocks)
    if concurrency:
        out = out.coalesce(concurrency)
    return out
