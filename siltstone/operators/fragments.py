"""Two-phase writes: a batch writer that leaves uncommitted fragments, and a committer.

For data that is produced batch by batch, or by several jobs that commit together.  The writer gives a
small DataFrame of messages; only these reach the driver.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from siltstone.manifest import Fragment, Snapshot, load, versions
from siltstone.namespace import Namespace
from siltstone.operators.write import MODES, check_rows, check_write, finish, target
from siltstone.schema import storable, to_struct
from siltstone.storage import Store, reliable

MESSAGES = "fragment string, schema string"


def to_arrow(block: Any, schema: pa.Schema | None = None) -> pa.Table:
    """A block (Arrow table or batch, pandas frame, dict of columns) as a table of the given schema."""
    import pandas as pd

    if isinstance(block, pa.RecordBatch):
        block = pa.Table.from_batches([block])
    if isinstance(block, dict):
        return pa.Table.from_pydict(block, schema=schema)
    if isinstance(block, pd.DataFrame):
        out = pa.Table.from_pandas(block, schema=schema, preserve_index=False)
        return out.replace_schema_metadata(schema.metadata if schema is not None else None)
    if not isinstance(block, pa.Table):
        raise TypeError(f"can't write a {type(block).__name__}")
    if schema is None:
        return block
    return block.select(schema.names).cast(schema) if block.num_rows else schema.empty_table()


def _tables(made: Any) -> Iterator[Any]:
    return iter((made,)) if isinstance(made, (pa.Table, pa.RecordBatch, dict)) or hasattr(made, "columns") else iter(made)


class FragmentWriter:
    """Writes each batch, or what ``transform`` makes of it, as one set of fragments.

    ``transform``: table to table, or to a generator of tables. ``schema``: cast to it; by default that of the first
    table of a batch. A batch is split at ``max_rows_per_file`` rows or about ``max_bytes_per_file``
    bytes. ``max_rows_per_group``: rows of a Parquet row group. With ``batch_size``, ``write`` deals rows
    into batches of exactly that many (but the last), in order of ``order_by``; without, batches are Spark's.
    ``write`` runs at once, so files are written once; a retried task leaves unnamed files only.
    The folder must be one that executors can open as files.
    """

    def __init__(self, uri: str, *, transform: Callable[[pa.Table], Any] | None = None, schema: pa.Schema | T.StructType | None = None, max_rows_per_file: int = 1024 * 1024, max_bytes_per_file: int | None = None, max_rows_per_group: int | None = None, data_storage_version: str | None = None, storage_options: dict[str, Any] | None = None):
        check_rows(1, max_rows_per_file)
        if max_bytes_per_file is not None and max_bytes_per_file <= 0:
            raise ValueError("max_bytes_per_file must be positive")
        self.uri, self.transform = uri, transform
        self.schema = to_arrow_schema(schema) if isinstance(schema, T.StructType) else schema
        if self.schema is not None:
            storable(to_struct(self.schema))
        self.max_rows, self.max_bytes, self.group = max_rows_per_file, max_bytes_per_file, max_rows_per_group
        self.options = dict(storage_options or {})

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items()}

    def put(self, block: Any) -> list[tuple[str, str]]:
        """Writes one batch; messages of its fragments."""
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        store = Store(self.uri, options=self.options)
        system, root = (fs.LocalFileSystem(), store.root) if store.local else fs.FileSystem.from_uri(store.root)
        out = []
        schema = self.schema
        source = to_arrow(block)
        rest: pa.Table | None = None
        folder = f"data/{uuid.uuid4().hex}"

        def flush(t: pa.Table) -> None:
            struct = storable(to_struct(t.schema))
            system.create_dir(f"{root}/{folder}", recursive=True)
            name = f"{folder}/part-{len(out):05d}-{uuid.uuid4().hex}.parquet"
            pq.write_table(t, f"{root}/{name}", filesystem=system, row_group_size=self.group, coerce_timestamps="us", allow_truncated_timestamps=False)
            size = system.get_file_info(f"{root}/{name}").size
            out.append((json.dumps({"path": name, "rows": t.num_rows, "size": size}), struct.json()))

        for made in _tables(self.transform(source) if self.transform else source):
            made = to_arrow(made, schema)
            if schema is None:
                schema = made.schema
            if not made.num_rows:
                continue
            rest = made if rest is None else pa.concat_tables([rest, made])
            limit = self.max_rows
            if self.max_bytes:
                limit = min(limit, max(1, math.floor(self.max_bytes * rest.num_rows / max(1, rest.nbytes))))
            while rest.num_rows >= limit:
                flush(rest.slice(0, limit))
                rest = rest.slice(limit)
        if rest is not None and rest.num_rows:
            flush(rest)
        return out

    def write(self, df: DataFrame, batch_size: int | None = None, order_by: list[str] | None = None) -> DataFrame:
        """Messages of all fragments, already written."""
        writer = self

        def messages(rows: list[tuple[str, str]]) -> pa.Table:
            return pa.table({"fragment": pa.array([r[0] for r in rows], pa.string()), "schema": pa.array([r[1] for r in rows], pa.string())})

        def by_batch(batches):
            for b in batches:
                if b.num_rows:
                    yield from messages(writer.put(b)).to_batches()

        def by_group(t: pa.Table) -> pa.Table:
            t = t.sort_by("_at").drop_columns(["_at", "_batch"])
            return messages(writer.put(t))

        if batch_size is None:
            got = df.mapInArrow(by_batch, MESSAGES)
        else:
            if batch_size <= 0:
                raise ValueError("batch_size must be positive")
            numbered = number_rows(df, order_by).withColumn("_batch", F.floor(F.col("_at") / batch_size))
            got = numbered.groupBy("_batch").applyInArrow(by_group, MESSAGES)
        rows = got.collect()
        return df.sparkSession.createDataFrame(rows, MESSAGES) if rows else df.sparkSession.createDataFrame([], MESSAGES)


def number_rows(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Adds ``_at``, 0, 1, 2, ... without putting all rows in one task.

    Rows are numbered within ranges of the order; the ranges' sizes (a row each) make the offsets.
    """
    from pyspark.sql import Window

    keyed = df.withColumn("_key", F.struct(*order_by) if order_by else F.monotonically_increasing_id())
    parts = keyed.repartitionByRange("_key").sortWithinPartitions("_key") if order_by else keyed
    parts = reliable(parts.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    offsets = sizes.withColumn("_off", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")  # one row a partition
    return parts.join(F.broadcast(offsets), "_part").withColumn("_at", F.col("_seq") - F.col("_first") + F.col("_off")).drop("_key", "_part", "_seq", "_first", "_off")


class FragmentCommitter:
    """Commits the messages of one or more writers as one version."""

    def __init__(self, uri: str | None = None, namespace: Namespace | None = None, table_id: list[str] | None = None, *, schema: pa.Schema | T.StructType | None = None, mode: str = "create", storage_options: dict[str, Any] | None = None):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
        check_write(uri, namespace, table_id, mode)
        self.location, self.options = target(uri, namespace, table_id, mode, storage_options)
        self.mode, self.schema = mode, storable(to_struct(schema)) if schema is not None else None

    def commit(self, messages: DataFrame) -> Snapshot | None:
        """A new version; none (and a warning) if there is no message."""
        from siltstone.operators.write import _footer

        store = Store(self.location, messages.sparkSession, self.options)
        base = load(store) if self.mode == "append" or versions(store) else None
        rows = messages.collect()  # a short text for each fragment
        schemas = {r["schema"] for r in rows}
        if len(schemas) > 1 and self.schema is None:
            raise ValueError("fragments differ in their schemas; give one")
        schema = self.schema or (base.schema if self.mode == "append" else T.StructType.fromJson(json.loads(next(iter(schemas)))) if rows else None)
        for s in schemas:
            got = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(s))}
            if got != {f.name: f.dataType for f in schema}:
                raise ValueError(f"a fragment's columns {got} don't match the schema")
        parts = [json.loads(r["fragment"]) for r in rows]
        fragments: list[Fragment] = [_footer(store, p["path"], p["size"]) for p in sorted(parts, key=lambda p: p["path"])]
        return finish(store, schema, fragments, self.mode, base, sorted({p["path"].rpartition("/")[0] for p in parts}))
