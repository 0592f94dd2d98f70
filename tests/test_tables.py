import threading
import warnings

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import siltstone as st
from siltstone.manifest import Fragment, commit, load
from siltstone.operators.write import collect_files
from siltstone.plans.layout import balance, compaction_bins
from siltstone.sources.scan import paths
from siltstone.storage import Store

PEOPLE = pd.DataFrame({"id": [1, 2, 3, 4, 5], "name": ["Alice", "Bob", "Charlie", "Diana", "Eve"], "age": [25, 30, 35, 40, 45], "score": [85.5, 92.0, 78.5, 88.0, 95.5]})
MORE = pd.DataFrame({"id": [6, 7], "name": ["Frank", "Grace"], "age": [50, 55], "score": [90.0, 85.0]})


def rows(df, *keys):
    return sorted(tuple(r[k] for k in keys) if keys else tuple(r) for r in df.collect())


def test_round_trip_keeps_names_order_and_types(spark, tmp_path):
    st.write_table(PEOPLE, str(tmp_path / "t"), spark=spark)
    got = st.read_table(str(tmp_path / "t"), spark=spark)
    assert got.columns == ["id", "name", "age", "score"]
    assert got.toPandas().sort_values("id").reset_index(drop=True).equals(PEOPLE)


def test_projection_order_and_filters(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(PEOPLE, uri, spark=spark)
    assert st.read_table(uri, spark=spark, columns=["score", "id"]).columns == ["score", "id"]
    for text, n in (("age > 30", 3), ("age >= 35", 3), ("age < 30", 1), ("age <= 30", 2), ("age >= 30 AND age < 40", 2), ("id = -1", 0), ("score > 75.0", 5), ("name IS NOT NULL", 5)):
        assert st.read_table(uri, spark=spark, columns=["name"], filter=text).count() == n
    assert st.open_table(uri, spark=spark).count_rows("age > 30") == 3


def test_filter_and_columns_reach_the_parquet_scan(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(PEOPLE, uri, spark=spark)
    plan = st.read_table(uri, spark=spark, columns=["name"], filter="age > 30")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(age), GreaterThan(age,30)]" in plan and "ReadSchema: struct<name:string,age:bigint>" in plan


def test_modes_and_versions(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(PEOPLE, uri, spark=spark)
    st.write_table(MORE, uri, spark=spark, mode="append")
    assert [v["rows"] for v in st.open_table(uri, spark=spark).versions()] == [5, 7]
    assert st.read_table(uri, spark=spark, dataset_options={"version": 1}).count() == 5
    st.write_table(MORE, uri, spark=spark, mode="overwrite")
    assert rows(st.read_table(uri, spark=spark), "id") == [(6,), (7,)]
    assert st.open_table(uri, spark=spark, version=2).read().count() == 7
    with pytest.raises(st.TableNotFound):
        st.read_table(uri, spark=spark, dataset_options={"version": 9})


def test_missing_table_fails_at_once(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        st.read_table(str(tmp_path / "none"), spark=spark)


def test_row_bounds_split_files_and_fragments_can_be_chosen(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(PEOPLE, uri, spark=spark, min_rows_per_file=1, max_rows_per_file=1)
    table = st.open_table(uri, spark=spark)
    assert [f.rows for f in table.fragments()] == [1] * 5
    assert st.read_table(uri, spark=spark, fragment_ids=[0, 1, 99]).count() == 2
    assert st.read_table(uri, spark=spark, fragment_ids=[]).count() == 5
    for low, high, text in ((0, 1, "min_rows_per_file must be positive"), (1, 0, "max_rows_per_file must be positive"), (3, 2, "must not be above")):
        with pytest.raises(ValueError, match=text):
            st.write_table(PEOPLE, uri, spark=spark, min_rows_per_file=low, max_rows_per_file=high)


def test_casts_on_write(spark, tmp_path):
    uri = str(tmp_path / "t")
    schema = pa.schema([("id", pa.int64()), ("name", pa.string()), ("age", pa.int32()), ("score", pa.float64()), ("extra", pa.string())])
    st.write_table(spark.createDataFrame(PEOPLE).selectExpr("*", "NULL AS extra"), uri, spark=spark, schema=schema)
    got = st.read_table(uri, spark=spark)
    assert [t for _, t in got.dtypes] == ["bigint", "string", "int", "double", "string"]
    assert got.where("extra IS NULL").count() == 5
    with pytest.raises(ValueError, match="not in the data"):
        st.write_table(MORE.drop(columns="age"), uri, spark=spark, mode="append")


def test_types_that_would_change_are_refused(spark, tmp_path):
    with pytest.raises(st.UnsupportedType):
        st.write_table(pa.table({"t": pa.array([1], pa.time64("us"))}), str(tmp_path / "t"), spark=spark, schema=pa.schema([("t", pa.time64("us"))]))
    with pytest.raises(st.UnsupportedType):
        st.write_table(spark.sql("SELECT NULL AS a"), str(tmp_path / "t"), spark=spark)


def test_empty_write_makes_no_table(spark, tmp_path):
    uri = str(tmp_path / "t")
    with pytest.warns(UserWarning):
        assert st.write_table(spark.createDataFrame(PEOPLE).where("id < 0"), uri, spark=spark) is None
    with pytest.raises(FileNotFoundError):
        st.read_table(uri, spark=spark)


def test_bad_arguments(spark, tmp_path):
    uri, space = str(tmp_path / "t"), st.connect("dir", {"root": str(tmp_path / "root")})
    for arguments in ({"uri": uri, "mode": "upsert"}, {}, {"namespace": space}, {"uri": uri, "namespace": space, "table_id": ["a"], "mode": "append"}):
        with pytest.raises(ValueError):
            st.write_table(PEOPLE, spark=spark, **arguments)
    with pytest.raises(TypeError):
        st.write_table(None, uri, spark=spark)
    for arguments in ({}, {"uri": uri, "namespace": space, "table_id": ["a"]}, {"namespace": space}):
        with pytest.raises(ValueError):
            st.read_table(spark=spark, **arguments)


def test_namespace(spark, tmp_path):
    space = st.connect("dir", {"root": str(tmp_path / "root")})
    where = {"spark": spark, "namespace": space, "table_id": ["default", "people"]}
    st.write_table(PEOPLE, **where)
    st.write_table(MORE, mode="append", **where)
    assert st.read_table(**where).count() == 7 and space.list_tables() == [["default", "people"]]
    with pytest.raises(FileExistsError):
        st.write_table(PEOPLE, **where)
    st.write_table(MORE, mode="overwrite", **where)
    st.add_columns(transform={"twice": "score * 2"}, **where)
    assert rows(st.read_table(**where), "id", "twice") == [(6, 180.0), (7, 170.0)]
    st.write_table(PEOPLE, str(tmp_path / "elsewhere"), spark=spark, namespace=space, table_id=["far"])
    assert space.describe_table(["far"]).location == str(tmp_path / "elsewhere")
    assert st.read_table(spark=spark, namespace=space, table_id=["far"]).count() == 5
    with pytest.raises(st.TableNotFound):
        st.read_table(spark=spark, namespace=space, table_id=["none"])


def test_a_failed_write_leaves_no_files(spark, tmp_path):
    uri = str(tmp_path / "t")
    with pytest.raises(Exception):
        st.write_table(spark.range(4).selectExpr("id", "assert_true(id < 2) AS a", "CAST(NULL AS STRING) AS b").selectExpr("id", "CAST(a AS STRING) AS a"), uri, spark=spark)
    assert not list((tmp_path / "t").rglob("*.parquet"))


def test_racing_appends_both_land(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(PEOPLE, uri, spark=spark)
    threads = [threading.Thread(target=lambda: st.write_table(MORE, uri, spark=spark, mode="append")) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    table = st.open_table(uri, spark=spark)
    assert table.count_rows() == 11 and len({f.id for f in table.fragments()}) == len(table.fragments())


def test_conflicts(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(PEOPLE, uri, spark=spark)
    base, store = st.open_table(uri, spark=spark).snapshot, Store(uri)
    st.write_table(MORE, uri, spark=spark, mode="append")
    for operation in ("add_columns",):
        with pytest.raises(st.CommitConflict):
            commit(store, base, operation, lambda now: now)
    st.open_table(uri, spark=spark).delete("id = 1")
    with pytest.raises(st.CommitConflict):
        commit(store, base, "delete", lambda now: now, touched=tuple(f.id for f in base.fragments))
    assert load(store).version == 3


def test_add_columns(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(spark.createDataFrame(PEOPLE).coalesce(1), uri, spark=spark, min_rows_per_file=1, max_rows_per_file=3)
    table = st.open_table(uri, spark=spark)
    before = [(f.id, f.rows) for f in table.fragments()]
    table.delete("id = 2")

    def double(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pandas(pd.DataFrame({"new_column": b.to_pandas()["score"] * 2}))

    table.add_columns(double, batch_size=2)
    assert table.schema.names[-1] == "new_column" and [(f.id, f.rows) for f in table.fragments()] == before
    assert rows(table.read(), "id", "new_column") == [(1, 171.0), (3, 157.0), (4, 176.0), (5, 191.0)]
    table.add_columns({"older": "age + 1"})
    table.add_columns(pa.table({"n": list(range(5))}))
    by_place = {r["id"]: r["n"] for r in table.read().collect()}
    assert sorted(by_place.values()) == sorted(set(by_place.values())) and len(by_place) == 4
    with pytest.raises(NotImplementedError):
        table.add_columns({"x": "1"}, filter="id > 1")
    with pytest.raises(ValueError, match="exist already"):
        table.add_columns({"older": "1"})
    with pytest.raises(ValueError):
        table.add_columns(pa.table({"m": [1]}))


def test_delete_hides_rows_and_nulls_stay(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(spark.sql("SELECT id, IF(id % 5 = 0, NULL, id) AS v FROM range(20)").coalesce(1), uri, spark=spark, min_rows_per_file=1, max_rows_per_file=10)
    table = st.open_table(uri, spark=spark)
    assert len(table.delete("v <= 9").fragments()) == 2 and table.count_rows() == 12
    assert rows(table.read(), "id")[:3] == [(0,), (5,), (10,)]
    assert table.delete("v <= 12").count_rows() == 10
    version = table.version
    assert table.delete("v < 0").version == version
    assert table.delete("id < 10").count_rows() == 8 and len(table.fragments()) == 1
    assert rows(table.take([0, 2, 1], columns=["id"]), "id") == [(10,), (13,), (14,)]
    assert table.count_rows("id >= 13") == table.read(filter="id >= 13").count() == 7


def test_row_ids_are_addresses(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(spark.range(6).coalesce(1), uri, spark=spark, min_rows_per_file=1, max_rows_per_file=2)
    got = rows(st.read_table(uri, spark=spark, columns=["id"], filter="id > 2", scanner_options={"with_row_id": True}))
    assert [r & 0xFFFFFFFF for _, r in got] == [1, 0, 1] and [r >> 32 for _, r in got] == [1, 2, 2]


@pytest.mark.parametrize("files,each,target,removed,added", [(2, 10, 100, 2, 1), (1000, 5, 20, 1000, 250)])
def test_compaction_bins(files, each, target, removed, added):
    fragments = tuple(Fragment(k, f"f{k}", each, 1) for k in range(files))
    bins = compaction_bins(fragments, st.CompactionOptions(target_rows_per_fragment=target))
    assert sum(map(len, bins)) == removed and len(bins) == added


def test_compaction(spark, tmp_path):
    uri = str(tmp_path / "t")
    for k in range(2):
        st.write_table(spark.range(10 * k, 10 * k + 10).selectExpr("id", "concat('row_', id) AS value").coalesce(1), uri, spark=spark, mode="append" if k else "create")
    table = st.open_table(uri, spark=spark)
    before = rows(table.read())
    table.delete("id < 9")
    got = st.compact_files(uri, st.CompactionOptions(materialize_deletions=True, materialize_deletions_threshold=0.5), spark=spark)
    assert got == st.CompactionMetrics(2, 1)
    table.refresh()
    assert rows(table.read()) == before[9:] and table.fragments()[0].deleted == 0
    assert table.compact(st.CompactionOptions(target_rows_per_fragment=11)) is None
    with pytest.raises(ValueError):
        table.compact(num_workers=0)


def test_small_files_are_made_by_several_tasks(spark, tmp_path, monkeypatch):
    uri = str(tmp_path / "t")
    monkeypatch.setattr("siltstone.operators.write.RUN_FILES", 4)
    monkeypatch.setattr("siltstone.operators.write.MANY_FILES", 20)
    st.write_table(spark.range(330).selectExpr("id", "if(id % 7 = 0, null, concat('row_', id)) AS `a b`").coalesce(1), uri, spark=spark, min_rows_per_file=1, max_rows_per_file=10)
    table = st.open_table(uri, spark=spark)
    assert [f.rows for f in table.fragments()] == [10] * 33 and [f.stats["id"][0] for f in table.fragments()] == list(range(0, 330, 10))
    assert len({f.path.rpartition("/")[2].split("-")[1] for f in table.fragments()}) > 1  # tasks
    assert {r["id"]: r["a b"] for r in table.read().collect()} == {k: None if k % 7 == 0 else f"row_{k}" for k in range(330)}
    assert [r["id"] for r in table.take([329, 0, 40, 39]).collect()] == [329, 0, 40, 39]
    store = Store(uri, spark)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1  # the first step's files are gone
    # folders are read as such only if all their files are wanted
    assert len(paths(store, table.fragments())) == 9 and len(paths(store, table.fragments()[1:])) == 11
    assert table.read(fragment_ids=[f.id for f in table.fragments()[1:]]).count() == 320
    assert table.compact(st.CompactionOptions(target_rows_per_fragment=100)) == st.CompactionMetrics(33, 4)
    assert [f.rows for f in table.fragments()] == [100, 100, 100, 30] and table.read().where("`a b` = 'row_' || id").count() == 330 - 48


def test_files_of_a_task_keep_their_order(tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("part-00000-x-c1000.parquet", "part-00000-x-c101.parquet", "part-100000-x-c000.parquet", "part-20000-x-c000.parquet"):
        pq.write_table(pa.table({"a": [1]}), tmp_path / "d" / name)
    assert [f.path[2:].split(".")[0] for f in collect_files(Store(str(tmp_path)), "d")] == ["part-00000-x-c101", "part-00000-x-c1000", "part-20000-x-c000", "part-100000-x-c000"]


def test_balance_takes_the_largest_first():
    fragments = [Fragment(k, "", n, 0) for k, n in enumerate((10, 50, 20, 30))]
    assert balance(fragments, 2) == [[1, 0], [3, 2]] and balance([], 3) == []


def test_writer_and_committer(spark, tmp_path):
    uri = str(tmp_path / "t")
    df = spark.range(10).selectExpr("id", "concat('str-', id) AS str").repartition(3)
    messages = st.FragmentWriter(uri).write(df, batch_size=5, order_by=["id"])
    assert messages.count() == 2
    with pytest.raises(FileNotFoundError):
        st.open_table(uri, spark=spark)
    st.FragmentCommitter(uri).commit(messages)
    table = st.open_table(uri, spark=spark)
    assert [f.rows for f in table.fragments()] == [5, 5] and rows(table.read(), "id") == [(k,) for k in range(10)]

    def twice(t: pa.Table):
        for half in (t.slice(0, 1), t.slice(1)):
            yield half.append_column("doubled", pa.array([2 * v for v in half["id"].to_pylist()], pa.int64()))

    wide = str(tmp_path / "wide")
    schema = pa.schema([("id", pa.int64()), ("str", pa.string()), ("doubled", pa.int64())])
    writer = st.FragmentWriter(wide, transform=twice, schema=schema, max_bytes_per_file=64)
    for k, mode in ((0, "create"), (1, "append")):
        st.FragmentCommitter(wide, mode=mode).commit(writer.write(df.where(f"id % 2 = {k}")))
    assert rows(st.read_table(wide, spark=spark), "id", "doubled") == [(k, 2 * k) for k in range(10)]
    with pytest.warns(UserWarning):
        assert st.FragmentCommitter(str(tmp_path / "no")).commit(writer.write(df.where("id < 0"))) is None


PREDICATES = {"id = 0": 1, "id = 499": 1, "id = 500": 1, "id = 1499": 1, "id = -1": 0, "id = 2000": 0, "id >= 10 AND id < 20": 10, "id >= 495 AND id < 505": 10, "id >= 250 AND id < 1250": 1000, "id >= 0 AND id < 1500": 1500, "id < 500": 500, "id > 999": 500, "id <= 505": 506, "id >= 995": 505, "500 > id AND NOT id = 3": 499}


def test_btree_gives_what_a_scan_gives(spark, tmp_path):
    uri = str(tmp_path / "t")
    for k in range(3):
        st.write_table(spark.range(500 * k, 500 * k + 500).selectExpr("id", "IF(id % 7 = 0, NULL, concat('k', id % 100)) AS s", "id / 4 AS x").orderBy("s"), uri, spark=spark, mode="append" if k else "create")
    table = st.create_scalar_index(uri, "id", "BTREE", spark=spark, num_workers=2)
    assert [(i["name"], i["type"]) for i in table.list_indices()] == [("id_idx", "BTree")]
    for text, n in PREDICATES.items():
        assert table.count_rows(text) == n, text
    table.create_scalar_index("s", "BTREE").create_scalar_index("x", "BTREE")
    more = ["s = 'k5'", "s > 'k98'", "x = 10.25", "x <= 1.5 AND s <> 'k1'"]
    expected = [rows(table.read(filter=t, scanner_options={"use_scalar_index": False})) for t in more]
    assert [rows(table.read(filter=t)) for t in more] == expected and all(expected)
    st.write_table(spark.range(1500, 1510).selectExpr("id", "'k5' AS s", "0.5D AS x"), uri, spark=spark, mode="append")
    assert table.refresh().count_rows("s = 'k5'") == len(expected[0]) + 10
    table.delete("id < 1000")
    table.compact(st.CompactionOptions(target_rows_per_fragment=5000))
    assert table.count_rows("id >= 990 AND id < 1010") == 10
    assert all(not i["fragment_ids"] for i in table.list_indices())


def test_index_errors(spark, tmp_path):
    uri = str(tmp_path / "t")
    st.write_table(pa.table({"id": [1, 2], "num": [1, 2], "text": ["a b", "b c"], "ok": [True, False]}), uri, spark=spark)

    def make(*a, **k):
        return st.create_scalar_index(uri, *a, spark=spark, **k)

    for arguments, options, error, text in (
        (("", "INVERTED"), {}, ValueError, "Column name cannot be empty"),
        (("text", "INVERTED"), {"num_workers": 0}, ValueError, "num_workers must be positive"),
        (("text", "INVALID"), {}, ValueError, r"Index type must be one of \['BTREE', 'BITMAP', 'LABEL_LIST', 'INVERTED', 'FTS', 'NGRAM', 'ZONEMAP'\], not 'INVALID'"),
        (("text", "BITMAP"), {}, ValueError, "currently supports"),
        (("none", "BTREE"), {}, ValueError, "Column 'none' not found"),
        (("num", "INVERTED"), {}, TypeError, "must be string type"),
        (("ok", "BTREE"), {}, TypeError, "must be numeric or string type"),
        (("text", 3), {}, ValueError, "string literal or IndexConfig"),
        (("text", "FTS"), {"fragment_ids": [77]}, ValueError, "do not exist"),
    ):
        with pytest.raises(error, match=text):
            make(*arguments, **options)
    make("text", st.IndexConfig("INVERTED", {"with_position": True}), "mine", index_uuid="abc")
    assert st.open_table(uri, spark=spark).list_indices()[0]["uuid"] == "abc"
    with pytest.raises(ValueError, match="mine.* already exists"):
        make("text", "FTS", "mine", replace=False)
    assert len(make("text", "FTS", "mine").list_indices()) == 1
    with pytest.warns(UserWarning):
        make("text", "FTS", batch_readhead=4)


def test_full_text(spark, tmp_path):
    uri = str(tmp_path / "t")
    texts = ["Distributed indexing is fast.", "indexing, distributed systems", "The quick brown fox", None, "fox fox fox"]
    st.write_table(pa.table({"id": list(range(5)), "text": texts}), uri, spark=spark, min_rows_per_file=1, max_rows_per_file=2)
    st.create_scalar_index(uri, "text", "INVERTED", spark=spark, with_position=True, remove_stop_words=False)
    table = st.open_table(uri, spark=spark)
    find = lambda q: [r["id"] for r in table.search(q).orderBy(*[__import__("pyspark").sql.functions.desc("_score"), "id"]).collect()]
    assert find("fox") == [4, 2]
    assert sorted(find("distributed fox")) == [0, 1, 2, 4]
    assert find('"distributed indexing"') == [0]
    assert sorted(find({"query": "distributed indexing", "operator": "and"})) == [0, 1]
    assert find("absent") == []
    st.write_table(pa.table({"id": [9], "text": ["a new fox"]}), uri, spark=spark, mode="append")
    table.refresh().delete("id = 4")
    assert sorted(find("fox")) == [2, 9]
    assert rows(table.scanner(columns=["id"], filter="id > 5", full_text_query="fox")) == [(9,)]


def test_texts_reach_workers_in_small_batches(spark, tmp_path, monkeypatch):
    from siltstone.operators import fulltext

    seen, made = str(tmp_path / "seen"), fulltext._inverted

    def watched(batches):
        def told():
            for b in batches:
                with open(seen, "a") as f:
                    f.write(f"{b.num_rows}\n")
                yield b

        yield from made(told())

    monkeypatch.setattr(fulltext, "_inverted", watched)
    monkeypatch.setattr(fulltext, "CHUNK_BYTES", 64)
    texts = [None, "", "!", "of the", "The of, the OF the", *[f"word {k} of many" for k in range(1000)], "x " * 500 + "of the"]
    uri = str(tmp_path / "t")
    st.write_table(spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1), uri, spark=spark)
    st.create_scalar_index(uri, "text", "INVERTED", spark=spark, with_position=True)
    assert max(map(int, open(seen))) <= 256 and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"
    assert rows(st.read_table(uri, spark=spark, columns=["id"], scanner_options={"full_text_query": '"of the"'})) == [(3,), (4,), (1005,)]
    table = st.open_table(uri, spark=spark)
    assert table.snapshot.indices[0].options["length"] == 2 + 5 + 4000 + 502


def test_stream_batches_are_written_once(spark, tmp_path):
    from siltstone.manifest import committed
    from siltstone.streaming.append import append_stream

    source, uri = str(tmp_path / "in"), str(tmp_path / "t")
    spark.range(30).repartition(3).write.parquet(source)
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(source)
    append_stream(stream, uri, str(tmp_path / "c"), {"availableNow": True}).awaitTermination()
    assert rows(st.read_table(uri, spark=spark)) == [(k,) for k in range(30)]
    assert committed(Store(uri), f"{tmp_path / 'c'}#0") and not committed(Store(uri), "other")


def test_queries_match_their_sql(spark):
    import duckdb

    from siltstone.queries import oracle_sql, queries

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("customer", "supplier", "part", "orders", "lineitem", "events", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    assert set(queries()) == set(oracle_sql())
    for name in ("scan_filter", "delete_rows", "add_col_sql", "compact_deletes", "btree_eq", "take_rows", "fts_phrase"):
        got, want = queries()[name](spark, folder), con.sql(oracle_sql()[name])
        assert sorted(got.columns) == sorted(want.columns)
        order = sorted(got.columns)
        assert sorted(map(repr, got.select(*order).toPandas().itertuples(index=False, name=None))) == sorted(map(repr, want.df()[order].itertuples(index=False, name=None))), name


def test_unknown_options(spark, tmp_path):
    """Options of the dataset without a meaning warn; options of the scanner that aren't known are errors, and hints are neither."""
    uri = str(tmp_path / "t")
    st.write_table(PEOPLE, uri, spark=spark)
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        st.read_table(uri, spark=spark, scanner_options={"batch_size": 10}, dataset_options={"odd": 1}, override_num_blocks=3, concurrency=2)
    assert any("odd" in str(w.message) for w in seen) and not any("batch_size" in str(w.message) for w in seen)
    with pytest.raises(ValueError, match="odd"):
        st.read_table(uri, spark=spark, scanner_options={"batch_size": 10, "odd": 1})


def test_scanner_options_that_change_results(spark, tmp_path):
    uri = str(tmp_path / "v")
    rows = [(k, [float(k), 1.0, 0.0]) for k in range(40)] + [(100, None), (101, [1.0]), (102, [float("nan"), 0.0, 0.0])]
    st.write_table(spark.createDataFrame(rows, "id int, v array<float>"), uri, spark=spark)
    with pytest.raises(ValueError, match="unknown"):
        st.read_table(uri, spark=spark, scanner_options={"prefilter": True})
    assert st.read_table(uri, spark=spark, scanner_options={"batch_size": 7}).count() == 43
    near = lambda **n: [(r["id"], round(r["_distance"], 6)) for r in st.read_table(uri, spark=spark, columns=["id"], filter="id <> 6", scanner_options={"nearest": {"column": "v", "q": [5.2, 1, 0], **n}}).collect()]
    assert near(k=3) == [(5, 0.04), (4, 1.44), (7, 3.24)]
    assert near(k=1, metric="dot") == [(39, round(1 - (39 * 5.2 + 1), 6))] and near(k=1, metric="cosine")[0][0] == 5
    assert len(near(k=500)) == 39
    with pytest.raises(ValueError, match="nearest"):
        near(metric="far")


def test_full_text_pages_and_scores(spark, tmp_path, monkeypatch):
    from siltstone.operators import fulltext

    monkeypatch.setattr(fulltext, "PAGE_POSTINGS", 200)
    uri = str(tmp_path / "t")
    rows = [(k, " ".join(["common", f"w{k}", f"w{k % 7}", "common"])) for k in range(300)]
    st.write_table(spark.createDataFrame(rows, "id int, t string").coalesce(1), uri, spark=spark)
    table = st.create_scalar_index(uri, "t", "INVERTED", spark=spark, with_position=True)
    (index,) = table.snapshot.indices
    assert len(table.fragments()) == 1 and len(index.files) > 2 and sum(f["rows"] for f in index.files) == sum(len(set(t.split())) for _, t in rows)
    assert table.search("common").count() == 300 and [r["id"] for r in table.search("w250").collect()] == [250]
    assert sorted(r["id"] for r in table.search('"w9 w2"').collect()) == [9]
    before = {r["id"]: r["_score"] for r in table.search("w3").collect()}
    st.write_table(spark.createDataFrame([(1000 + k, "w3 " * 9) for k in range(5)], "id int, t string"), uri, spark=spark, mode="append")
    after = {r["id"]: r["_score"] for r in st.open_table(uri, spark=spark).search("w3").collect()}
    assert len(after) == len(before) + 5 and all(abs(after[k] - v) < 1e-9 for k, v in before.items())


def test_transforms_run_once_a_row(spark, tmp_path):
    uri, calls = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    st.write_table(spark.range(1000).coalesce(1), uri, spark=spark)

    def twice(b):
        calls.add(b.num_rows)
        return pa.RecordBatch.from_arrays([pc.multiply(b.column(0), 2)], names=["twice"])

    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)
    try:
        st.open_table(uri, spark=spark).add_columns(st.BatchUDF(twice, pa.schema([("twice", pa.int64())])), read_version=1)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert calls.value == 1000 and st.read_table(uri, spark=spark).where("twice = 2 * id").count() == 1000
    st.write_table(spark.range(3).withColumn("twice", F.lit(0).cast("bigint")), uri, spark=spark, mode="append")
    with pytest.raises(st.CommitConflict):
        st.open_table(uri, spark=spark).add_columns({"more": "id"}, read_version=2)


def test_other_namespaces(spark, tmp_path):
    made = []
    st.register_namespace("mine", lambda properties: made.append(properties) or st.DirectoryNamespace(properties["at"]))
    space = st.connect("mine", {"at": str(tmp_path)})
    st.write_table(spark.range(3), spark=spark, namespace=space, table_id=["a", "b"])
    assert made == [{"at": str(tmp_path)}] and st.read_table(spark=spark, namespace=space, table_id=["a", "b"]).count() == 3
    with pytest.raises(ValueError, match="no namespace of kind"):
        st.connect("other", {})
