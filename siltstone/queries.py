"""One query for each operator, over the driver's tables, and its SQL.

A query writes a table of its own to a folder that driver and executors share, works on it, and
returns what it then reads.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone import BatchUDF, CompactionOptions, FragmentCommitter, FragmentWriter, connect, create_scalar_index, open_table, read_table, write_table
from siltstone.streaming.append import append_stream

Query = Callable[[SparkSession, str], DataFrame]
_made: dict[str, Query] = {}
_sql: dict[str, str] = {}
_local: list[str] = []


def _place(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="siltstone-"))
            atexit.register(shutil.rmtree, _local[0], True)
        shared = _local[0]
    return f"{shared}/tables/{uuid.uuid4().hex}"


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _made[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return add


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stored(spark: SparkSession, sf_dir: str, name: str, **options) -> str:
    uri = _place(spark)
    write_table(_load(spark, sf_dir, name), uri, spark=spark, **options)
    return uri


# scans


@_query("SELECT * FROM orders")
def scan_all(spark, sf_dir):
    return read_table(_stored(spark, sf_dir, "orders"), spark=spark)


@_query("SELECT o_orderkey, o_totalprice FROM orders")
def scan_project(spark, sf_dir):
    return read_table(_stored(spark, sf_dir, "orders"), spark=spark, columns=["o_orderkey", "o_totalprice"])


@_query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def scan_filter(spark, sf_dir):
    return read_table(_stored(spark, sf_dir, "orders"), spark=spark, columns=["o_orderkey", "o_totalprice"], filter="o_totalprice > 100000 AND o_orderstatus = 'F'")


@_query("SELECT l_orderkey, l_extendedprice, l_discount FROM lineitem WHERE l_quantity > 30 AND l_discount >= 0.05")
def scan_project_filter(spark, sf_dir):
    return read_table(_stored(spark, sf_dir, "lineitem"), spark=spark, columns=["l_orderkey", "l_extendedprice", "l_discount"], filter="l_quantity > 30 AND l_discount >= 0.05")


@_query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderpriority IS NULL")
def filter_unprojected(spark, sf_dir):
    return read_table(_stored(spark, sf_dir, "orders"), spark=spark, columns=["o_orderkey"], filter="o_orderpriority = '1-URGENT' OR o_orderpriority IS NULL")


@_query("SELECT count(*) AS n FROM orders WHERE o_totalprice > 100000")
def filtered_count(spark, sf_dir):
    return open_table(_stored(spark, sf_dir, "orders"), spark=spark).read(columns=["o_orderkey"], filter="o_totalprice > 100000").agg(F.count("*").alias("n"))


@_query("SELECT count(*) AS n FROM orders")
def manifest_count(spark, sf_dir):
    return spark.createDataFrame([(open_table(_stored(spark, sf_dir, "orders"), spark=spark).count_rows(),)], "n bigint")


@_query("SELECT * FROM orders WHERE o_orderkey % 4 IN (0, 2)")
def fragment_subset(spark, sf_dir):
    orders, uri, ids = _load(spark, sf_dir, "orders"), _place(spark), []
    for k in range(4):
        seen = {f.id for f in open_table(uri, spark=spark).fragments()} if k else set()
        write_table(orders.where(F.col("o_orderkey") % 4 == k), uri, spark=spark, mode="append" if k else "create")
        if k in (0, 2):
            ids += [f.id for f in open_table(uri, spark=spark).fragments() if f.id not in seen]
    return read_table(uri, spark=spark, fragment_ids=[*ids, 4_000_000_000])


@_query("SELECT * FROM events WHERE event_id % 2 = 0")
def time_travel_v1(spark, sf_dir):
    events, uri = _load(spark, sf_dir, "events"), _place(spark)
    write_table(events.where("event_id % 2 = 0"), uri, spark=spark)
    write_table(events.where("event_id % 2 = 1"), uri, spark=spark, mode="append")
    return read_table(uri, spark=spark, dataset_options={"version": 1})


@_query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5")
def scan_limit_offset(spark, sf_dir):
    return read_table(_stored(spark, sf_dir, "orders"), spark=spark, columns=["o_orderkey", "o_totalprice"], scanner_options={"order_by": [F.desc("o_totalprice"), "o_orderkey"], "limit": 20, "offset": 5})


_POINT = [round(0.1 * (k * 7 % 5 - 2), 1) for k in range(64)]


@_query(f"SELECT round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (embedding[i]::DOUBLE - {_POINT}[i]::DOUBLE) ** 2))), 4) AS distance FROM embeddings WHERE vec_id % 3 > 0 AND len(embedding) = 64 ORDER BY distance LIMIT 25")
def scan_nearest(spark, sf_dir):
    rows = read_table(_stored(spark, sf_dir, "embeddings"), spark=spark, columns=["vec_id"], filter="vec_id % 3 > 0", scanner_options={"nearest": {"column": "embedding", "q": _POINT, "k": 25}})
    return rows.select(F.round(F.sqrt("_distance"), 4).alias("distance"))


@_query("SELECT count(*) AS n, count(*) AS distinct_ids FROM orders")
def row_ids(spark, sf_dir):
    rows = read_table(_stored(spark, sf_dir, "orders", max_rows_per_file=4000, min_rows_per_file=1), spark=spark, columns=["o_orderkey"], scanner_options={"with_row_id": True})
    return rows.agg(F.count("*").alias("n"), F.countDistinct("_rowid").alias("distinct_ids"))


# writes


@_query("SELECT * FROM orders")
def append_rows(spark, sf_dir):
    orders, uri = _load(spark, sf_dir, "orders"), _place(spark)
    write_table(orders.where("o_orderkey % 2 = 0"), uri, spark=spark)
    write_table(orders.where("o_orderkey % 2 = 1"), uri, spark=spark, mode="append")
    return read_table(uri, spark=spark)


@_query("SELECT * FROM orders WHERE o_orderkey % 3 = 1")
def overwrite_rows(spark, sf_dir):
    orders, uri = _load(spark, sf_dir, "orders"), _place(spark)
    write_table(orders, uri, spark=spark)
    write_table(orders.where("o_orderkey % 3 = 1"), uri, spark=spark, mode="overwrite")
    return read_table(uri, spark=spark)


@_query("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_totalprice AS FLOAT) AS o_totalprice, CAST(NULL AS VARCHAR) AS extra FROM orders")
def cast_on_write(spark, sf_dir):
    uri = _place(spark)
    schema = pa.schema([("o_orderkey", pa.int32()), ("o_totalprice", pa.float32()), ("extra", pa.string())])
    write_table(_load(spark, sf_dir, "orders").withColumn("extra", F.lit(None)), uri, spark=spark, schema=schema)
    return read_table(uri, spark=spark)


@_query("SELECT p_partkey, p_retailprice * 2 AS doubled FROM part")
def fragment_writer_commit(spark, sf_dir):
    uri = _place(spark)

    def double(t: pa.Table):
        yield pa.table({"p_partkey": t["p_partkey"], "doubled": pc.multiply(t["p_retailprice"], 2.0)})

    writer = FragmentWriter(uri, transform=double, schema=pa.schema([("p_partkey", pa.int64()), ("doubled", pa.float64())]))
    committer = FragmentCommitter(uri)
    committer.commit(writer.write(_load(spark, sf_dir, "part").select("p_partkey", "p_retailprice")))
    return read_table(uri, spark=spark)


@_query("SELECT p_partkey, p_name FROM part")
def fragment_writer_batches(spark, sf_dir):
    uri = _place(spark)
    messages = FragmentWriter(uri).write(_load(spark, sf_dir, "part").select("p_partkey", "p_name"), batch_size=500, order_by=["p_partkey"])
    FragmentCommitter(uri).commit(messages)
    return read_table(uri, spark=spark)


@_query("SELECT * FROM supplier")
def namespace_roundtrip(spark, sf_dir):
    space = connect("dir", {"root": _place(spark)})
    write_table(_load(spark, sf_dir, "supplier"), spark=spark, namespace=space, table_id=["sales", "supplier"])
    return read_table(spark=spark, namespace=space, table_id=["sales", "supplier"])


@_query("SELECT * FROM events")
def stream_append(spark, sf_dir):
    uri, source = _place(spark), _load(spark, sf_dir, "events")
    folder = f"{uri}-in"
    source.repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    append_stream(stream, uri, f"{uri}-checkpoint", {"availableNow": True}).awaitTermination()
    return read_table(uri, spark=spark)


# evolution, deletion, take


@_query("SELECT *, l_extendedprice * (1 - l_discount) AS net, l_returnflag = 'R' AS returned FROM lineitem")
def add_col_sql(spark, sf_dir):
    table = open_table(_stored(spark, sf_dir, "lineitem"), spark=spark)
    return table.add_columns({"net": "l_extendedprice * (1 - l_discount)", "returned": "l_returnflag = 'R'"}).read()


@_query("SELECT *, value * 2 AS twice FROM events")
def add_col_udf(spark, sf_dir):
    table = open_table(_stored(spark, sf_dir, "events"), spark=spark)

    def twice(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pc.multiply(b.column(0), 2.0)], names=["twice"])

    return table.add_columns(BatchUDF(twice, pa.schema([("twice", pa.float64())])), read_columns=["value"]).read()


@_query("SELECT * FROM orders WHERE (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END > 100000) IS NOT TRUE")
def delete_rows(spark, sf_dir):
    table = open_table(_stored(spark, sf_dir, "orders"), spark=spark)
    return table.delete("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END > 100000").read()


@_query("SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders WHERE NOT o_orderkey BETWEEN 100 AND 199) WHERE p IN (0, 17, 99, 100, 101, 1234)")
def take_rows(spark, sf_dir):
    uri = _place(spark)
    write_table(_load(spark, sf_dir, "orders").orderBy("o_orderkey"), uri, spark=spark, max_rows_per_file=1000, min_rows_per_file=1)
    return open_table(uri, spark=spark).delete("o_orderkey BETWEEN 100 AND 199").take([1234, 0, 17, 99, 100, 101], columns=["o_orderkey", "o_totalprice"])


# compaction


@_query("SELECT *, TRUE AS fewer FROM customer")
def compact_small(spark, sf_dir):
    table = open_table(_stored(spark, sf_dir, "customer", max_rows_per_file=50, min_rows_per_file=1), spark=spark)
    got = table.compact(CompactionOptions(target_rows_per_fragment=5000))
    return table.read().withColumn("fewer", F.lit(got.fragments_added < got.fragments_removed))


@_query("SELECT *, 0::BIGINT AS hidden FROM orders WHERE (o_orderpriority = '1-URGENT') IS NOT TRUE")
def compact_deletes(spark, sf_dir):
    table = open_table(_stored(spark, sf_dir, "orders", max_rows_per_file=3000, min_rows_per_file=1), spark=spark)
    table.delete("o_orderpriority = '1-URGENT'").compact({"materialize_deletions_threshold": 0.05})
    return table.read().withColumn("hidden", F.lit(sum(f.deleted for f in table.fragments())).cast("bigint"))


# indices


def _btree(spark, sf_dir, name, column, filter):
    uri = _place(spark)
    write_table(_load(spark, sf_dir, name).orderBy(F.xxhash64(column)), uri, spark=spark, max_rows_per_file=1000, min_rows_per_file=1)
    create_scalar_index(uri, column, "BTREE", spark=spark)
    return read_table(uri, spark=spark, filter=filter)


@_query("SELECT * FROM orders WHERE o_orderkey = 4711 % (SELECT count(*) FROM orders)")
def btree_eq(spark, sf_dir):
    key = 4711 % _load(spark, sf_dir, "orders").count()
    return _btree(spark, sf_dir, "orders", "o_orderkey", f"o_orderkey = {key}")


@_query("SELECT * FROM orders WHERE o_orderkey >= 495 AND o_orderkey < 505")
def btree_range(spark, sf_dir):
    return _btree(spark, sf_dir, "orders", "o_orderkey", "o_orderkey >= 495 AND 505 > o_orderkey")


@_query("SELECT * FROM customer WHERE c_name = 'Customer#000000042' OR c_name = 'Customer#42'")
def btree_string(spark, sf_dir):
    one = _btree(spark, sf_dir, "customer", "c_name", "c_name = 'Customer#000000042'")
    return one.unionByName(_btree(spark, sf_dir, "customer", "c_name", "c_name = 'Customer#42'"))


@_query("SELECT * FROM orders WHERE o_orderkey = -1")
def btree_absent(spark, sf_dir):
    return _btree(spark, sf_dir, "orders", "o_orderkey", "o_orderkey = -1")


@_query("SELECT * FROM events WHERE event_id > 900")
def btree_after_append(spark, sf_dir):
    events, uri = _load(spark, sf_dir, "events"), _place(spark)
    write_table(events.where("event_id < 800"), uri, spark=spark)
    create_scalar_index(uri, "event_id", "BTREE", spark=spark)
    write_table(events.where("event_id >= 800"), uri, spark=spark, mode="append")
    return read_table(uri, spark=spark, filter="event_id > 900")


_TERMS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"


@_query(f"SELECT doc_id FROM documents WHERE list_contains({_TERMS}, 'thing')")
def fts_term(spark, sf_dir):
    uri = _stored(spark, sf_dir, "documents")
    create_scalar_index(uri, "text", "INVERTED", spark=spark)
    return read_table(uri, spark=spark, columns=["doc_id"], scanner_options={"full_text_query": "thing"})


@_query(f"SELECT doc_id FROM documents WHERE list_has_any({_TERMS}, ['thing', 'ering'])")
def fts_or(spark, sf_dir):
    uri = _stored(spark, sf_dir, "documents")
    create_scalar_index(uri, "text", "FTS", spark=spark, remove_stop_words=False)
    return read_table(uri, spark=spark, columns=["doc_id"], scanner_options={"full_text_query": "Thing ering"})


@_query(f"SELECT doc_id FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(list_filter(range(1, len(t)), lambda i: t[i] = 'of' AND t[i + 1] = 'the')) > 0")
def fts_phrase(spark, sf_dir):
    uri = _stored(spark, sf_dir, "documents")
    create_scalar_index(uri, "text", "INVERTED", spark=spark, with_position=True)
    return read_table(uri, spark=spark, columns=["doc_id"], scanner_options={"full_text_query": '"of the"'})


@_query(f"SELECT doc_id FROM documents WHERE list_has_all({_TERMS}, ['thing', 'the'])")
def fts_and_after_append(spark, sf_dir):
    docs, uri = _load(spark, sf_dir, "documents"), _place(spark)
    write_table(docs.where("doc_id % 2 = 0"), uri, spark=spark)
    create_scalar_index(uri, "text", "INVERTED", spark=spark)
    write_table(docs.where("doc_id % 2 = 1"), uri, spark=spark, mode="append")
    return read_table(uri, spark=spark, columns=["doc_id"], scanner_options={"full_text_query": {"query": "thing the", "operator": "and"}})


# Spark's operators over tables that are read


@_query("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def agg_over_scan(spark, sf_dir):
    return read_table(_stored(spark, sf_dir, "orders"), spark=spark).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@_query("SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment")
def join_two_tables(spark, sf_dir):
    orders, customer = (read_table(_stored(spark, sf_dir, n), spark=spark) for n in ("orders", "customer"))
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@_query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS place FROM orders")
def window_over_scan(spark, sf_dir):
    orders = read_table(_stored(spark, sf_dir, "orders"), spark=spark, columns=["o_orderkey", "o_custkey", "o_totalprice"])
    return orders.select("o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("place"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = _place(spark)
    write_table(_load(spark, sf_dir, "lineitem"), uri, spark=spark, min_rows_per_file=1, max_rows_per_file=1000)
    return read_table(uri, spark=spark, columns=["l_orderkey", "l_extendedprice", "l_discount"], filter="l_quantity > 30 AND l_discount >= 0.05")


def queries() -> dict[str, Query]:
    return dict(_made)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
