"""Building scalar indices."""

from __future__ import annotations

import logging
import uuid
import warnings
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.manifest import Index, Snapshot, commit
from siltstone.operators import btree, fulltext
from siltstone.operators.write import collect_files
from siltstone.plans.layout import balance
from siltstone.sources.scan import located
from siltstone.table import Table, open_table

log = logging.getLogger("siltstone")

# The names of index types, in the order that messages give them.
INDEX_TYPES = ["BTREE", "BITMAP", "LABEL_LIST", "INVERTED", "FTS", "NGRAM", "ZONEMAP"]
BUILDABLE = {"BTREE", "FTS", "INVERTED"}


@dataclass(frozen=True)
class IndexConfig:
    index_type: str
    parameters: dict[str, Any] = field(default_factory=dict)


def _check_type(schema: T.StructType, column: str, kind: str) -> None:
    t = schema[column].dataType
    t = t.elementType if isinstance(t, T.ArrayType) else t
    if kind in ("INVERTED", "FTS"):
        if not isinstance(t, T.StringType):
            raise TypeError(f"Column {column} must be string type for {kind} index, got {t.simpleString()}")
    elif not isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType)):
        raise TypeError(f"Column {column} must be numeric or string type for BTREE index, got {t.simpleString()}")


def create_scalar_index(
    dataset: Table | str,
    column: str,
    index_type: str | IndexConfig,
    name: str | None = None,
    *,
    replace: bool = True,
    train: bool = True,
    fragment_ids: list[int] | None = None,
    index_uuid: str | None = None,
    num_workers: int = 4,
    storage_options: dict[str, Any] | None = None,
    spark: SparkSession | None = None,
    **kwargs: Any,
) -> Table:
    """Builds a B-tree or full-text index and commits it; gives the table at its new version.

    Rows are located and range-partitioned once into pages: one for each worker that fragments are dealt to (by rows), more where
    there are more entries than a task sorts well. One commit.
    ``fragment_ids``: cover only these. An index of the same name is replaced, or with ``replace=False`` an error.
    ``train=False``: an empty index that covers nothing yet. Full-text options: ``with_position``,
    ``remove_stop_words``, ``lower_case``. Rows added later are scanned until the index is built again.
    """
    if not column:
        raise ValueError("Column name cannot be empty")
    if num_workers <= 0:
        raise ValueError(f"num_workers must be positive, got {num_workers}")
    options = dict(kwargs)
    if isinstance(index_type, IndexConfig):
        options, index_type = dict(index_type.parameters) | options, index_type.index_type
    elif not isinstance(index_type, str):
        raise ValueError(f"index_type must be a string literal or IndexConfig object, got {type(index_type)}")
    kind = index_type.upper()
    if kind not in INDEX_TYPES:
        raise ValueError(f"Index type must be one of {INDEX_TYPES}, not '{index_type}'")
    if kind not in BUILDABLE:
        raise ValueError(f"this table layer currently supports indices of {sorted(BUILDABLE)}; '{index_type}' is none of them")
    table = open_table(dataset, spark=spark, storage_options=storage_options) if isinstance(dataset, str) else dataset
    spark, store, base = table.spark, table.store, table.refresh().snapshot
    if column not in base.schema.names:
        raise ValueError(f"Column '{column}' not found. Available: {base.schema.names}")
    _check_type(base.schema, column, kind)
    name = name or f"{column}_idx"
    if not replace and any(i.name == name for i in base.indices):
        raise ValueError(f"Index with name '{name}' already exists. Set replace=True to replace it.")
    fragments = list(base.fragments)
    if fragment_ids is not None:
        unknown = sorted(set(fragment_ids) - {f.id for f in fragments})
        if unknown:
            raise ValueError(f"Fragment IDs {unknown} do not exist in dataset")
        fragments = [f for f in fragments if f.id in set(fragment_ids)]
    if not fragments:
        raise ValueError("Dataset contains no fragments")
    for k in list(options):
        if k not in ("with_position", "remove_stop_words", "lower_case"):
            warnings.warn(f"option {k!r} has no meaning here", stacklevel=2)
            del options[k]
    dealt = balance(fragments, min(num_workers, len(fragments)))
    live = {f.id: f.live for f in fragments}
    loads = [sum(live[i] for i in ids) for ids in dealt]
    log.info("index %s: %d fragments dealt to %d workers, %d to %d rows each", name, len(fragments), len(dealt), min(loads, default=0), max(loads, default=0))
    rows = located(spark, store, base, fragments if train else []).select(f"`{column}`", "_fragment", "_row")
    text = kind != "BTREE"
    folder, staging = f"_indices/{index_uuid or uuid.uuid4().hex}", f"_indices/.staging-{uuid.uuid4().hex}"
    try:
        # at least a page a worker, and never more entries than a task sorts well
        if text:
            made_terms = fulltext.postings(rows, column, options)
            with fulltext.small_batches(spark):
                (made_terms if options.get("with_position", False) else made_terms.drop("positions")).write.options(**store.options).parquet(store.path(staging))
            staged = spark.read.options(**store.options).schema(made_terms.schema if options.get("with_position", False) else made_terms.drop("positions").schema).parquet(store.path(staging))
            count, length = staged.agg(F.count("*"), F.sum("tf")).first()
            entries: DataFrame = fulltext.build(staged, max(len(dealt), -(-count // fulltext.PAGE_POSTINGS)))
            options |= {"documents": sum(live.values()) if train else 0, "length": int(length or 0)}
        else:
            entries = btree.build(rows, column, max(len(dealt), sum(live.values()) // 4_000_000))
        entries.write.options(**store.options).mode("overwrite").parquet(store.path(folder))
        bound = "term" if text else "value"
        files = tuple({"path": f.path, "rows": f.rows} | ({"min": f.stats[bound][0], "max": f.stats[bound][1]} if f.stats.get(bound) else {}) for f in collect_files(store, folder))
        made = Index(folder.rpartition("/")[2], name, column, base.field_ids[column], "Inverted" if text else "BTree", tuple(f.id for f in fragments) if train else (), base.version, options, files)

        def change(now: Snapshot) -> Snapshot:
            from dataclasses import replace as changed

            live = {f.id for f in now.fragments}
            index = changed(made, fragments=tuple(f for f in made.fragments if f in live))
            return changed(now, indices=(*[i for i in now.indices if i.name != name], index))

        commit(store, base, "index", change, index_name=name)
    except BaseException:
        store.remove(folder)
        raise
    finally:
        store.remove(staging)
    return table.refresh()
