"""Table handles."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.manifest import Fragment, Snapshot, load, versions
from siltstone.namespace import Namespace, resolve
from siltstone.storage import Store


class Table:
    """A table at one version; operations that commit move it to the new one."""

    def __init__(self, uri: str, spark: SparkSession | None = None, version: int | None = None, storage_options: dict[str, Any] | None = None):
        self.spark = spark or SparkSession.builder.getOrCreate()
        self.uri, self.storage_options = uri, dict(storage_options or {})
        self.store = Store(uri, self.spark, self.storage_options)
        self.snapshot: Snapshot = load(self.store, version)

    @property
    def version(self) -> int:
        return self.snapshot.version

    @property
    def schema(self) -> T.StructType:
        return self.snapshot.schema

    def refresh(self) -> Table:
        self.snapshot = load(self.store)
        return self

    def versions(self) -> list[dict]:
        out = []
        for v in versions(self.store):
            s = load(self.store, v)
            out.append({"version": v, "operation": s.operation, "time": s.time, "rows": s.rows})
        return out

    def fragments(self) -> tuple[Fragment, ...]:
        return self.snapshot.fragments

    get_fragments = fragments

    def list_indices(self) -> list[dict]:
        return [{"name": i.name, "type": i.kind, "uuid": i.uuid, "fields": [i.column], "version": i.version, "fragment_ids": set(i.fragments)} for i in self.snapshot.indices]

    def read(self, **options: Any) -> DataFrame:
        """``read_table`` at this version."""
        from siltstone.sources.scan import read_table

        dataset = {"version": self.version} | dict(options.pop("dataset_options", None) or {})
        return read_table(self.uri, spark=self.spark, storage_options=self.storage_options, dataset_options=dataset, **options)

    def to_table(self, columns: Sequence[str] | None = None, filter: str | None = None) -> pa.Table:
        return self.read(columns=columns, filter=filter).toArrow()

    def scanner(self, **options: Any) -> DataFrame:
        columns, filter = options.pop("columns", None), options.pop("filter", None)
        return self.read(columns=columns, filter=filter, scanner_options=options)

    def count_rows(self, filter: str | None = None) -> int:
        """Without a filter from the manifest alone."""
        return self.read(columns=[], filter=filter).count() if filter else self.snapshot.rows

    def __len__(self) -> int:
        return self.count_rows()

    def take(self, positions: Sequence[int], columns: Sequence[str] | None = None) -> DataFrame:
        """Rows by position (live rows, in order of fragments); reads only their fragments. Order is that of ``positions``."""
        from siltstone.sources.scan import located

        chosen: list[tuple[int, int, int]] = []
        fragments, total = [f for f in self.snapshot.fragments if f.live], self.snapshot.rows
        starts, at = [], 0
        for f in fragments:
            starts.append(at)
            at += f.live
        for k, p in enumerate(positions):
            if not 0 <= p < total:
                raise IndexError(f"position {p} is outside of {total} rows")
            i = bisect_right(starts, p) - 1
            chosen.append((k, fragments[i].id, p - starts[i]))
        hit = [f for f in fragments if f.id in {c[1] for c in chosen}]
        rows = located(self.spark, self.store, self.snapshot, hit)
        wanted = self.spark.createDataFrame(chosen, "_k bigint, _fragment bigint, _at bigint")
        worn = [f.id for f in hit if f.deleted]
        plain = rows.where(~F.col("_fragment").isin(worn)).withColumn("_at", F.col("_row")) if worn else rows.withColumn("_at", F.col("_row"))
        if worn:  # only here positions differ from addresses
            from pyspark.sql import Window

            order = Window.partitionBy("_fragment").orderBy("_row")
            plain = plain.unionByName(rows.where(F.col("_fragment").isin(worn)).withColumn("_at", (F.row_number().over(order) - 1).cast("bigint")))
        out = plain.join(F.broadcast(wanted), ["_fragment", "_at"]).orderBy("_k")
        return out.select(*[f"`{c}`" for c in (columns if columns is not None else self.schema.names)])

    def delete(self, predicate: str) -> Table:
        from siltstone.operators.delete import delete_rows

        delete_rows(self.spark, self.store, self.refresh().snapshot, predicate)
        return self.refresh()

    def add_columns(self, transform: Any, **options: Any) -> Table:
        from siltstone.operators.evolve import add_columns

        add_columns(self.uri, spark=self.spark, transform=transform, storage_options=self.storage_options, **options)
        return self.refresh()

    def create_scalar_index(self, column: str, index_type: Any, name: str | None = None, **options: Any) -> Table:
        from siltstone.operators.index import create_scalar_index

        return create_scalar_index(self, column, index_type, name, **options)

    def search(self, query: str | dict, column: str | None = None) -> DataFrame:
        """Full-text hits with ``_rowid`` and ``_score``."""
        from siltstone.operators.fulltext import search

        return search(self.spark, self.store, self.snapshot, query, column)

    def compact(self, options: Any = None, num_workers: int = 4):
        from siltstone.operators.compact import compact_files

        return compact_files(self, options, num_workers)


def open_table(uri: str | None = None, *, spark: SparkSession | None = None, namespace: Namespace | None = None, table_id: list[str] | None = None, version: int | None = None, storage_options: dict[str, Any] | None = None) -> Table:
    location, options = resolve(uri, namespace, table_id, storage_options)
    return Table(location, spark, version, options)
