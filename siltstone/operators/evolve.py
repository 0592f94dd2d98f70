"""Adding columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.manifest import Fragment, Snapshot, commit, load
from siltstone.namespace import Namespace, resolve
from siltstone.operators.write import collect_folders
from siltstone.schema import conform, storable, to_struct
from siltstone.sources.scan import located
from siltstone.storage import Store


@dataclass(frozen=True)
class BatchUDF:
    """A function of record batches with the schema of what it returns."""

    function: Callable[[pa.RecordBatch], pa.RecordBatch]
    output_schema: pa.Schema | T.StructType | None = None


def rewrite(rows: DataFrame, store: Store, schema: T.StructType, key: str, keys: Iterable[int], max_rows: int = 0) -> dict[int, list[Fragment]]:
    """Writes rows (with ``key``, one of ``keys``, and an order: ``_fragment``, ``_row``) so that each key has files of its own.

    One shuffle by key; a task's sort keeps the old order of rows. Tasks aren't merged by their bytes, as files cost time too.
    """
    folder, keys, spark = f"data/{uuid.uuid4().hex}", list(keys), rows.sparkSession
    tasks = max(1, min(len(keys), max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    out = rows.repartition(tasks, key).sortWithinPartitions(key, "_fragment", "_row").select(*[f"`{n}`" for n in schema.names], F.col(key).alias("_key"))
    try:
        # 0: no bound, whatever the session says
        out.write.options(**store.options).partitionBy("_key").option("maxRecordsPerFile", max_rows).parquet(store.path(folder))
        return dict(zip(keys, collect_folders(store, [f"{folder}/_key={k}" for k in keys])))
    except BaseException:
        store.remove(folder)
        raise


def _applied(rows: DataFrame, function: Callable, read: list[str], made: T.StructType, batch_size: int) -> DataFrame:
    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, batch_size):
                b = whole.slice(i, batch_size)
                new = function(b.select(read))
                new = pa.Table.from_batches([new]).combine_chunks() if isinstance(new, pa.RecordBatch) else new
                if new.num_rows != b.num_rows:
                    raise ValueError(f"the transform made {new.num_rows} rows of {b.num_rows}")
                if sorted(new.schema.names) != sorted(made.names):
                    raise ValueError(f"the transform made columns {new.schema.names}, not {made.names}")
                cols = [new[n].combine_chunks().cast(t) for n, t in zip(made.names, types)]
                yield pa.RecordBatch.from_arrays([*b.columns, *[c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in cols]], names=[*b.schema.names, *made.names])

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in made]
    return rows.mapInArrow(run, T.StructType([*rows.schema, *made]))


def add_columns(
    uri: str | None = None,
    *,
    spark: SparkSession | None = None,
    namespace: Namespace | None = None,
    table_id: list[str] | None = None,
    transform: dict[str, str] | BatchUDF | Callable | Iterable,
    filter: str | None = None,
    read_columns: list[str] | None = None,
    reader_schema: pa.Schema | T.StructType | None = None,
    read_version: int | None = None,
    storage_options: dict[str, Any] | None = None,
    batch_size: int = 1024,
    concurrency: int | None = None,
) -> Snapshot:
    """Adds columns to every row and commits; fragments keep their ids and rows their places.

    ``transform``: {name: SQL expression}; a function of record batches (only ``read_columns``, by default all)
    that returns only the new columns, whose types come from ``reader_schema`` or from a trial on some
    rows; a ``BatchUDF``; or an Arrow table, reader or iterable of batches with one row for each row, in
    order of fragments (it comes from the driver, so it must fit there). ``read_version``: the version to start from.
    Deleted rows are transformed too. ``filter`` is not supported, as every row needs a value.
    """
    spark = spark or SparkSession.builder.getOrCreate()
    if filter is not None:
        raise NotImplementedError("add_columns fills every row; filter is not supported")
    if batch_size <= 0:
        raise ValueError(f"batch_size must be positive, got {batch_size}")
    location, options = resolve(uri, namespace, table_id, storage_options)
    store = Store(location, spark, options)
    base = load(store, read_version)
    if not base.fragments:
        raise ValueError("the table has no fragment")
    read = list(read_columns) if read_columns is not None else base.schema.names
    if unknown := [c for c in read if c not in base.schema.names]:
        raise ValueError(f"columns {unknown} not found; the table has {base.schema.names}")
    rows = located(spark, store, base, base.fragments, deleted=True)
    if isinstance(transform, dict):
        out = rows.select("*", *[F.expr(e).alias(n) for n, e in transform.items()])
        made = T.StructType([out.schema[n] for n in transform]) if not set(transform) & set(base.schema.names) else T.StructType([T.StructField(n, T.StringType()) for n in transform])
    elif isinstance(transform, BatchUDF) or callable(transform):
        function = transform.function if isinstance(transform, BatchUDF) else transform
        given = transform.output_schema if isinstance(transform, BatchUDF) and transform.output_schema is not None else reader_schema
        if given is None:
            trial = rows.select(*[f"`{c}`" for c in read]).limit(16).toArrow().combine_chunks().to_batches()
            given = function(trial[0] if trial else pa.RecordBatch.from_pylist([], schema=pa.schema([]))).schema
        made = to_struct(given)
        out = None
    else:
        reader = transform if isinstance(transform, pa.Table) else pa.Table.from_batches(list(transform), schema=reader_schema if isinstance(reader_schema, pa.Schema) else None)
        physical = sum(f.rows for f in base.fragments)
        if reader.num_rows != physical:
            raise ValueError(f"the reader has {reader.num_rows} rows, the table {physical}")
        made, first = to_struct(reader.schema), 0
        starts = []
        for f in base.fragments:
            starts.append((f.id, first))
            first += f.rows
        new = spark.createDataFrame(reader.append_column("_at", pa.array(range(physical), pa.int64())))
        at = spark.createDataFrame(starts, "_fragment bigint, _start bigint")
        out = rows.join(F.broadcast(at), "_fragment").withColumn("_at", F.col("_start") + F.col("_row")).join(new, "_at").drop("_at", "_start")
    made = storable(made)
    if clash := [n for n in made.names if n in base.schema.names]:
        raise ValueError(f"columns {clash} exist already")
    if out is None:
        out = _applied(rows, function, read, made, batch_size)
    schema = T.StructType([*base.schema, *made])
    out = conform(out, T.StructType([*schema, T.StructField("_fragment", T.LongType()), T.StructField("_row", T.LongType())]))
    if concurrency:
        out = out.coalesce(concurrency)
    files = rewrite(out, store, schema, "_fragment", [f.id for f in base.fragments])

    def change(now: Snapshot) -> Snapshot:
        ids, following = dict(base.field_ids), now.next_field
        for f in made:
            ids[f.name] = following
            following += 1
        new = []
        for f in base.fragments:
            (g,) = files[f.id]
            new.append(replace(f, path=g.path, size=g.size, stats=g.stats))
        # rows keep their addresses, so indices stay
        return replace(now, schema=schema, field_ids=ids, next_field=following, fragments=tuple(new), indices=base.indices if read_version is not None else now.indices)

    return commit(store, base, "add_columns", change, tuple(f.id for f in base.fragments))
