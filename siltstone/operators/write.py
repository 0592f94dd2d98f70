"""Writes: Parquet files by Spark's own writer, then one atomic commit by the driver."""

from __future__ import annotations

import datetime
import decimal
import math
import re
import uuid
import warnings
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siltstone.errors import TableNotFound
from siltstone.manifest import Fragment, Snapshot, commit, load, versions, with_fragments
from siltstone.namespace import Namespace
from siltstone.schema import conform, storable, to_struct
from siltstone.storage import Store

MODES = ("create", "append", "overwrite")
MIN_ROWS, MAX_ROWS = 1024 * 1024, 64 * 1024 * 1024
#: Making a file costs more than its rows where it has fewer; then tasks share a partition's rows in runs of so many files.
SMALL_FILE, RUN_FILES = 10_000, 64
#: More footers than these are read by tasks.
MANY_FILES = 1000


def check_rows(min_rows: int, max_rows: int) -> None:
    if min_rows <= 0:
        raise ValueError(f"min_rows_per_file must be positive, got {min_rows}")
    if max_rows <= 0:
        raise ValueError(f"max_rows_per_file must be positive, got {max_rows}")
    if min_rows > max_rows:
        raise ValueError(f"min_rows_per_file ({min_rows}) must not be above max_rows_per_file ({max_rows})")


def check_write(uri: str | None, namespace: Namespace | None, table_id: list[str] | None, mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if (namespace is None) != (table_id is None):
        raise ValueError("'namespace' and 'table_id' must be given together")
    if mode == "append" and uri is not None and namespace is not None:
        raise ValueError("append takes either 'uri' or 'namespace' with 'table_id', not both")
    if uri is None and namespace is None:
        raise ValueError("give 'uri', or 'namespace' and 'table_id'")


def target(uri: str | None, namespace: Namespace | None, table_id: list[str] | None, mode: str, storage_options: dict[str, Any] | None) -> tuple[str, dict]:
    """Location to write to; new tables of a namespace are registered, at ``uri`` if it is given."""
    options = dict(storage_options or {})
    if namespace is None:
        return uri, options
    try:
        if mode == "create":
            raise TableNotFound
        info = namespace.describe_table(table_id)
    except TableNotFound:
        if mode == "append":
            raise
        info = namespace.create_empty_table(table_id, uri) if uri else namespace.create_empty_table(table_id)
    return info.location, options | info.storage_options


def _stat(v: Any) -> Any:
    if isinstance(v, bool) or isinstance(v, int) or isinstance(v, str) and len(v) <= 256:
        return v
    return v if isinstance(v, float) and math.isfinite(v) else None


def _footer(store: Store, name: str, size: int) -> Fragment:
    """Rows and statistics from a file's footer; no data is read."""
    if store.local:
        meta = pq.read_metadata(store.path(name))
    else:
        from pyarrow import fs

        filesystem, path = fs.FileSystem.from_uri(store.path(name))
        with filesystem.open_input_file(path) as f:
            meta = pq.read_metadata(f)
    stats: dict[str, list] = {}
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            if "." in column.path_in_schema or column.physical_type == "INT96":
                continue
            s = column.statistics
            old = stats.setdefault(column.path_in_schema, [None, None, 0])
            if old is None:
                continue
            # without bounds nothing can be told of the file; string bounds are whole ones
            if s is None or not s.has_null_count or not s.has_min_max and s.num_values:
                stats[column.path_in_schema] = None
                continue
            old[2] += s.null_count
            if s.has_min_max:
                low, high = _stat(s.min), _stat(s.max)
                if low is None or high is None or isinstance(s.min, (decimal.Decimal, datetime.date, bytes)):
                    stats[column.path_in_schema] = None
                    continue
                old[0], old[1] = low if old[0] is None else min(old[0], low), high if old[1] is None else max(old[1], high)
    # a column of NaN has no trustworthy bounds
    return Fragment(-1, name, meta.num_rows, size, {k: v for k, v in stats.items() if v is not None and (v[0] is not None or v[2] == meta.num_rows)})


def _turn(name: str) -> tuple:
    """Order of a job's files: by task and by count, whose digits grow with them."""
    told = re.match(r"part-(\d+)-.*-c(\d+)\b", name)
    return (int(told[1]), int(told[2]), name) if told else (-1, -1, name)


def _footers(store: Store, names: list[tuple[str, int]]) -> list[Fragment]:
    """Footers of files, in their order: by threads, or by Spark's tasks if there are many."""
    if len(names) <= MANY_FILES or store.spark is None:
        with ThreadPoolExecutor(16) as pool:
            return list(pool.map(lambda x: _footer(store, *x), names))
    plain, context = Store(store.root, options=store.options), store.spark.sparkContext
    return context.parallelize(names, min(len(names), 4 * context.defaultParallelism)).map(lambda x: _footer(plain, *x)).collect()


def collect_files(store: Store, folder: str, suffix: str = ".parquet") -> list[Fragment]:
    """The non-empty files of a folder, in the order of a job's tasks and else by name."""
    return collect_folders(store, [folder], suffix)[0]


def collect_folders(store: Store, folders: list[str], suffix: str = ".parquet") -> list[list[Fragment]]:
    """``collect_files`` of each folder."""
    names = [[(f"{folder}/{n}", size) for n, size in sorted(store.list(folder), key=lambda x: _turn(x[0])) if n.endswith(suffix) and not n.startswith((".", "_"))] for folder in folders]
    found = _footers(store, [x for part in names for x in part])
    for f in found:
        if not f.rows:
            store.remove(f.path)
    rest = iter(found)
    return [[f for f in islice(rest, len(part)) if f.rows] for part in names]


def _known_rows(df: DataFrame) -> int | None:
    """Row count if the optimizer knows it; never runs a job."""
    rows = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
    return int(str(rows.get())) if rows.isDefined() else None


def stage(df: DataFrame, store: Store, max_rows: int, min_rows: int = 1) -> tuple[str, list[Fragment]]:
    """Writes the rows into a folder of their own.

    Small files are written in two steps, as a task makes its files one after another: first runs of rows for many files,
    then each run by a task of its own. Rows keep their order.
    """
    folder = f"data/{uuid.uuid4().hex}"
    known = _known_rows(df) if min_rows > 1 else None
    if known is not None:
        df = df.coalesce(max(1, known // min_rows))
    run = max_rows if max_rows >= SMALL_FILE else max_rows * RUN_FILES
    try:
        df.write.options(**store.options).option("maxRecordsPerFile", run).mode("errorifexists").parquet(store.path(folder))
        files = collect_files(store, folder)
    except BaseException:
        store.remove(folder)
        raise
    return (folder, files) if all(f.rows <= max_rows for f in files) else _split(df, store, folder, files, max_rows)


def _split(df: DataFrame, store: Store, folder: str, files: list[Fragment], max_rows: int) -> tuple[str, list[Fragment]]:
    """Writes a folder's files anew, each as several, and removes it."""
    from siltstone.operators.evolve import rewrite
    from siltstone.sources.scan import located

    runs = with_fragments(df.schema, files, None, False)
    try:
        made = rewrite(located(df.sparkSession, store, runs, runs.fragments), store, df.schema, "_fragment", range(len(files)), max_rows)
    finally:
        store.remove(folder)
    split = [f for k in range(len(files)) for f in made[k]]
    return split[0].path.rsplit("/", 2)[0], split


def to_frame(spark: SparkSession, data: Any) -> DataFrame:
    import pandas as pd

    if isinstance(data, DataFrame):
        return data
    if isinstance(data, pa.RecordBatch):
        data = pa.Table.from_batches([data])
    if isinstance(data, dict):
        data = pa.table(data)
    if isinstance(data, (pd.DataFrame, pa.Table)):
        return spark.createDataFrame(data)
    raise TypeError(f"a DataFrame, Arrow table, pandas frame or dict is needed, not {type(data).__name__}")


def write_table(
    data: Any,
    uri: str | None = None,
    *,
    spark: SparkSession | None = None,
    namespace: Namespace | None = None,
    table_id: list[str] | None = None,
    schema: pa.Schema | T.StructType | None = None,
    mode: str = "create",
    min_rows_per_file: int = MIN_ROWS,
    max_rows_per_file: int = MAX_ROWS,
    data_storage_version: str | None = None,
    storage_options: dict[str, Any] | None = None,
    concurrency: int | None = None,
    transaction: str = "",
) -> Snapshot | None:
    """Writes a DataFrame (or Arrow, pandas, dict data) and commits it as a new version.

    ``create`` and ``overwrite`` replace the fragments (older versions stay readable), ``append`` adds to
    them. Columns are cast to ``schema``, or on append to the table's. No rows: a warning, and no
    version. ``min_rows_per_file`` is a hint, used when the number of rows is known without a job.
    ``data_storage_version`` is accepted; there is one format. ``concurrency``: at most so many write tasks.
    ``transaction``: a name kept with the version, by which a repeated write can be recognised.
    Files of a failed write are removed.
    """
    check_write(uri, namespace, table_id, mode)
    check_rows(min_rows_per_file, max_rows_per_file)
    spark = spark or SparkSession.builder.getOrCreate()
    df = to_frame(spark, data)
    location, options = target(uri, namespace, table_id, mode, storage_options)
    store = Store(location, spark, options)
    base = load(store) if mode == "append" or versions(store) else None
    wanted = to_struct(schema) if schema is not None else base.schema if mode == "append" else None
    wanted = storable(wanted if wanted is not None else df.schema)
    if mode == "append" and {f.name: f.dataType for f in wanted} != {f.name: f.dataType for f in base.schema}:
        raise ValueError("the schema differs from the table's")
    df = conform(df, wanted)
    if concurrency:
        df = df.coalesce(concurrency)
    folder, fragments = stage(df, store, max_rows_per_file, min_rows_per_file)
    return finish(store, wanted, fragments, mode, base, [folder], transaction)


def finish(store: Store, schema: T.StructType, fragments: list[Fragment], mode: str, base: Snapshot | None, folders: list[str], transaction: str = "") -> Snapshot | None:
    """Commits staged files, or removes them."""
    if not fragments:
        for f in folders:
            store.remove(f)
        warnings.warn("no rows were written, so no version was made", stacklevel=3)
        return None
    append = mode == "append"
    try:
        return commit(store, base, "append" if append else "overwrite", lambda now: with_fragments(now.schema if append else schema, fragments, now, append), transaction=transaction)
    except BaseException:
        for f in folders:
            store.remove(f)
        raise
