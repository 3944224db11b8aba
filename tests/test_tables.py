import pickle

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablekit.catalog import Catalog, Schema
from tablekit.functions.rowkind import RowKind
from tablekit.sources.snapshot import CommitConflict


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    c = Catalog.create({"warehouse": f"file://{tmp_path_factory.mktemp('w')}"}, spark)
    c.create_database("d", False)
    return c


def make(catalog, name, fields, rows=(), commits=None, **schema):
    fields = pa.schema(fields)
    catalog.create_table(f"d.{name}", Schema(fields, **schema), False)
    t = catalog.get_table(f"d.{name}")
    for some in commits or ([rows] if rows else []):
        put(t, fields, some)
    return t


def put(t, fields, rows, builder=None):
    b = builder or t.new_batch_write_builder()
    w = b.new_write()
    w.write_arrow(pa.Table.from_pylist([dict(zip(fields.names, r)) for r in rows], fields))
    return b.new_commit().commit(w.prepare_commit())


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


SIMPLE = [("f0", pa.int32()), ("f1", pa.string()), ("f2", pa.string())]
FIRST = [(1, "a", "A"), (2, "b", "B"), (3, "c", "C"), (4, None, "D")]
SECOND = [(5, "e", "E"), (6, "f", "F"), (7, "g", "G"), (8, "h", None)]


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_append_filters(catalog, kind):
    t = make(catalog, f"simple_{kind}", SIMPLE, commits=[FIRST, SECOND], options={"file.format": kind})
    rb = t.new_read_builder()
    b = rb.new_predicate_builder()
    keys = lambda p: sorted(r[0] for r in rb.with_filter(p).to_df().collect())
    g1 = b.and_predicates([b.less_than("f0", 7), b.greater_or_equal("f0", 2), b.between("f0", 0, 5), b.is_not_in("f1", ["a", "b"]), b.is_in("f2", ["A", "B", "D", "E", "F", "G"]), b.is_not_null("f1")])
    g2 = b.or_predicates([b.startswith("f1", "a"), b.endswith("f2", "C"), b.contains("f2", "E"), b.equal("f1", "f"), b.is_null("f2")])
    assert keys(g1) == [5] and keys(g2) == [1, 3, 5, 6, 8] and keys(b.and_predicates([g1, g2])) == [5]
    assert keys(b.not_equal("f1", "f")) == [1, 2, 3, 5, 7, 8]
    assert [r[0] for r in rb.with_filter(b.greater_than("f0", 3)).with_filter(b.less_or_equal("f0", 4)).to_df().collect()] == [4]
    assert rb.with_projection(["f2", "f0"]).to_df().columns == ["f2", "f0"] and rb.with_limit(1).to_df().count() == 1
    assert rb.with_limit(1, coarse=True).to_df().count() == 8 and len(rb.to_df().collect()) == 8
    with pytest.raises(ValueError, match=r"The field f9 is not in field list \['f0', 'f1', 'f2'\]."):
        b.equal("f9", 1)
    with pytest.raises(ValueError):
        rb.with_projection(["f9"])


def test_primary_key_merge(catalog):
    fields = [pa.field("f0", pa.int32(), False), *SIMPLE[1:]]
    t = make(catalog, "pk", fields, commits=[FIRST, [(2, "x", "X"), (3, "y", "Y"), (6, "z", "Z")]], primary_keys=["f0"], options={"bucket": "1", "sort-engine": "min-heap"})
    assert rows_of(t.to_df()) == rows_of(t.spark.createDataFrame([(1, "a", "A"), (2, "x", "X"), (3, "y", "Y"), (4, None, "D"), (6, "z", "Z")], "a int, b string, c string"))
    rb = t.new_read_builder()
    b = rb.new_predicate_builder()
    assert rb.with_filter(b.equal("f1", "b")).with_projection(["f2"]).to_df().count() == 0  # an older version stays hidden
    w = (wb := t.new_batch_write_builder()).new_write()
    w.write_changes(pa.Table.from_pylist([{"f0": 1, "f1": "a", "f2": "A"}, {"f0": 3, "f1": "y", "f2": "Y"}], pa.schema(fields)), [RowKind.DELETE, RowKind.UPDATE_BEFORE])
    wb.new_commit().commit(w.prepare_commit())
    assert sorted(r[0] for r in t.to_df().collect()) == [2, 4, 6]
    assert rb.at_snapshot(2).to_df().count() == 5
    assert t.new_read_builder().new_read().to_arrow(rb.new_scan().plan().splits()).schema.field("f0").nullable is False


def test_primary_key_rules(catalog, spark):
    fields = [("k", pa.int32()), ("p", pa.string()), ("v", pa.string())]
    t = make(catalog, "dynamic", fields, primary_keys=["k"])
    with pytest.raises(TypeError, match="Doesn't support writing dynamic bucket or cross partition table."):
        t.new_batch_write_builder()
    with pytest.raises(ValueError):
        catalog.create_table("d.bad", Schema(pa.schema(fields), ["p"], ["p"]), False)
    t = make(catalog, "part", fields, partition_keys=["p"], primary_keys=["p", "k"], options={"bucket": "2"}, commits=[[(1, "007", "a"), (2, "007", "b")], [(2, "007", "new"), (2, "x/y=z", "c")]])
    assert rows_of(t.to_df()) == [(1, "007", "a"), (2, "007", "new"), (2, "x/y=z", "c")]
    rb = t.new_read_builder()
    found = rb.with_filter(rb.new_predicate_builder().equal("p", "007"))
    assert {f.partition for s in found.new_scan().plan().splits() for f in s.files} == {("007",)} and found.to_df().count() == 2
    a, b = t.new_batch_write_builder(), t.new_batch_write_builder()
    wa, wb = a.new_write(), b.new_write()
    for w in (wa, wb):
        w.write_arrow(pa.Table.from_pylist([{"k": 1, "p": "007", "v": "z"}], pa.schema(fields)))
    a.new_commit().commit(wa.prepare_commit())
    with pytest.raises(CommitConflict):
        b.new_commit().commit(wb.prepare_commit())


def test_ignore_delete_and_frames(catalog, spark):
    t = make(catalog, "ign", [("k", pa.int32()), ("v", pa.string())], primary_keys=["k"], options={"bucket": "1", "ignore-delete": "true"})
    df = spark.createDataFrame([(1, "a", 0, 0), (1, "a", 1, 3), (2, "b", 2, 3), (3, "c", 3, 0), (3, "d", 4, 2)], "k int, v string, s long, kind int")
    w = (b := t.new_batch_write_builder()).new_write()
    with pytest.raises(ValueError):
        w.write_dataframe(df)
    w.write_dataframe(df, "s", "kind")
    b.new_commit().commit(w.prepare_commit())
    assert rows_of(t.to_df()) == [(1, "a"), (3, "d")]


def test_overwrite(catalog):
    fields = pa.schema([("f0", pa.int32()), ("f1", pa.string())])
    t = make(catalog, "over", fields, [(1, "apple"), (2, "banana")], partition_keys=["f0"], options={"dynamic-partition-overwrite": "false"})
    put(t, fields, [(1, "watermelon")], t.new_batch_write_builder().overwrite({"f0": "1"}))
    assert rows_of(t.to_df()) == [(1, "watermelon"), (2, "banana")]
    b = t.new_batch_write_builder().overwrite({"f0": "2"})
    b.new_commit().commit(b.new_write().prepare_commit())
    assert rows_of(t.to_df()) == [(1, "watermelon")]
    put(t, fields, [(3, "Neo")], t.new_batch_write_builder().overwrite())
    assert rows_of(t.to_df()) == [(3, "Neo")]
    u = make(catalog, "over2", fields, [(1, "a"), (2, "b")], partition_keys=["f0"], options={"dynamic-partition-overwrite": "true"})
    put(u, fields, [(2, "c")], u.new_batch_write_builder().overwrite())
    assert rows_of(u.to_df()) == [(1, "a"), (2, "c")]


def test_interfaces(catalog, spark):
    fields = pa.schema([("f0", pa.int32()), ("f1", pa.string())])
    t = make(catalog, "api", fields)
    rb = t.new_read_builder()
    assert rb.new_scan().plan().splits() == []
    w = (b := t.new_batch_write_builder()).new_write()
    w.write_arrow(pa.table({"f0": [1, 2, 3], "f1": ["a", "b", "c"]}, fields))
    w.write_arrow_batch(pa.record_batch({"f0": [4], "f1": ["d"]}, fields))
    w.write_pandas(pd.DataFrame({"f0": [5, 6], "f1": ["e", None]}))
    messages = w.prepare_commit()
    w.close()
    b.new_commit().commit(messages)
    with pytest.raises(ValueError, match="Input schema isn't consistent with table schema."):
        b.new_write().write_arrow(pa.table({"f0": pa.array([1], pa.int64()), "f1": ["a"]}))
    splits = pickle.loads(pickle.dumps(rb.new_scan().plan().splits()))
    assert sum(s.row_count() for s in splits) == 6 and all(s.file_size() and s.file_paths() for s in splits)
    read = rb.new_read()
    assert read.to_arrow(splits).schema == fields and read.to_arrow_batch_reader(splits).read_all().num_rows == 6
    assert len(read.to_pandas(splits)) == 6 and len(list(read.to_iterator(splits))) == 6
    assert sorted(read.to_duckdb(splits, "t").execute("SELECT f0 FROM t WHERE f0 < 4").fetchall()) == [(1,), (2,), (3,)]
    read.to_view(splits, "api_view")
    assert spark.sql("SELECT count(*) FROM api_view").first()[0] == 6
    assert rb.with_projection([]).new_read().to_pandas(splits).empty
    with pytest.raises(ValueError):
        Catalog.create({"warehouse": "x", "max-workers": "0"}, spark)


def test_types(catalog):
    with pytest.raises(ValueError, match="Found unsupported data type list<item: int32> for field _array."):
        catalog.create_table("d.lists", Schema(pa.schema([("_array", pa.list_(pa.int32()))])), False)
    with pytest.warns(UserWarning):
        catalog.create_table("d.nulls", Schema(pa.schema([("n", pa.null())])), False)
    with pytest.raises(ValueError):
        catalog.create_table("nodot", Schema(pa.schema([("n", pa.int8())])), False)
    with pytest.raises(ValueError):
        catalog.create_database("d", False)
    catalog.create_database("d", True)
    t = make(catalog, "kinds", [("a", pa.int8()), ("b", pa.int16()), ("c", pa.float32()), ("d", pa.float64()), ("e", pa.bool_())], [(1, 10, 1.1, 1.0, True), (2, 20, 2.0, 2.0, False)])
    rb = t.new_read_builder()
    p = rb.new_predicate_builder()
    for name, value in (("a", 1), ("b", 10), ("c", 1.1), ("d", 1.0), ("e", True)):
        assert rb.with_filter(p.equal(name, value)).to_df().count() == 1


def test_filters_reach_the_files(catalog):
    t = make(catalog, "plan", SIMPLE, FIRST)
    rb = t.new_read_builder()
    plan = rb.with_filter(rb.new_predicate_builder().equal("f0", 1)).with_projection(["f1"]).to_df()._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(f0,1)" in plan and "f2" not in plan.split("ReadSchema")[1]


def test_streams(catalog, spark, tmp_path):
    t = make(catalog, "stream", [("id", pa.int64())])
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "in"))
    from tablekit.streaming.sink import write_stream

    def run(checkpoint):
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        write_stream(stream, t, checkpoint).trigger(availableNow=True).start().awaitTermination()

    for folder in ("a", "b"):  # two streams whose checkpoints have one base name
        run(str(tmp_path / folder / "ck"))
        run(str(tmp_path / folder / "ck"))  # nothing new
    assert t.to_df().agg(F.sum("id"), F.count("*")).first() == (90, 20)
    # a crash after the snapshot was published and before Spark took note: the batch comes again
    found = t.snapshots.latest()
    b = t.new_batch_write_builder()
    w = b.new_write()
    w.write_dataframe(spark.range(3))
    for writer, number in found.streams.items():
        assert b.new_commit().commit(w.prepare_commit(), stream=(writer, number)) == found.id
    assert t.to_df().count() == 20


def test_event_time(spark, tmp_path):
    from tablekit.streaming.windows import drained, running_totals, windowed

    minutes = lambda *m: spark.createDataFrame([(f"2024-01-01 10:{x:02d}:00", x) for x in m], "t string, v int").selectExpr("to_timestamp(t) AS t", "v")
    for df in (minutes(1, 2, 12), minutes(3, 40), minutes(41), minutes(4, 42)):  # the last one's 4 comes after its window has been closed
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("t timestamp, v int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = drained(windowed(stream(), "t", "10 minutes", [], [F.count("*").alias("n")], delay="5 minutes"), str(tmp_path / "w")).collect()
    assert sorted((r["window_start"].minute, r["n"]) for r in got) == [(0, 3), (10, 1)]
    got = drained(running_totals(stream().withColumn("k", F.lit(1)), "k", "v"), str(tmp_path / "s"), "update").collect()
    assert sorted((r["n"], r["total"]) for r in got) == [(3, 15.0), (5, 58.0), (6, 99.0), (8, 145.0)]


def test_joins_with_nulls(spark):
    from tablekit.operators.relational import asof_join, range_join

    left = spark.createDataFrame([(1, 10), (1, None), (None, 10), (2, 5), (1, 3), (1, 30)], "k int, t int")
    right = spark.createDataFrame([(1, 4, "a"), (1, None, "b"), (None, 1, "c"), (1, 9, "d"), (2, 6, "e"), (1, 12, None)], "k int, t int, v string")
    expected = sorted([(1, 10, "d"), (1, None, None), (None, 10, None), (2, 5, None), (1, 3, None), (1, 30, None)], key=str)
    for bucket in (None, F.floor(F.col("__t") / 4)):
        assert rows_of(asof_join(left, right, ["k"], "t", "t", ["v"], bucket)) == expected
    named = left.withColumnsRenamed({"t": "__t", "k": "__side"})
    assert rows_of(asof_join(named, right.withColumnsRenamed({"k": "__side"}), ["__side"], "__t", "t", ["v"])) == expected
    ranges = spark.createDataFrame([("x", 0, 5), ("y", 4, 10_000_000), ("z", 7, 7), (None, None, 3)], "n string, lo int, hi int")
    assert rows_of(range_join(left.filter("k = 1"), ranges, "t", "lo", "hi", 1.0).select("t", "n")) == [(10, "y"), (3, "x"), (30, "y")]
    assert range_join(left, ranges.limit(0), "t", "lo", "hi").count() == 0


def test_writes_are_refused_or_replaced(catalog, spark):
    t = make(catalog, "nullseq", [("k", pa.int32())], primary_keys=["k"], options={"bucket": "1"})
    w = t.new_batch_write_builder().new_write()
    with pytest.raises(ValueError, match="no sequence"):
        w.write_dataframe(spark.createDataFrame([(1, None), (2, 3)], "k int, s int"), "s")
    fields = pa.schema([("p", pa.string()), ("v", pa.int32())])
    t = make(catalog, "nullpart", fields, [(None, 1), ("a", 2), ("null", 3)], partition_keys=["p"])
    put(t, fields, [(None, 9)], t.new_batch_write_builder().overwrite({"p": None}))
    assert rows_of(t.to_df()) == [("a", 2), ("null", 3), (None, 9)]
    with pytest.raises(ValueError, match="Avro module"):
        make(catalog, "avro", fields, options={"file.format": "avro"})
    catalog.create_database("with", False, {"owner": "me"})
    assert catalog.database_properties("with") == {"owner": "me"} and catalog.database_properties("d") == {}


def test_versions_of_a_table(catalog):
    fields = pa.schema([pa.field("k", pa.int32(), False), ("v", pa.string())])
    t = make(catalog, "versions", fields, commits=[[(i, "old") for i in range(20)], [(i, "new") for i in range(5)]], primary_keys=["k"], options={"bucket": "3"})
    rb = t.new_read_builder()
    b = rb.new_predicate_builder()
    assert len(rb.new_scan().plan().splits()) == 3 and {f.bucket for s in rb.new_scan().plan().splits() for f in s.files} == {0, 1, 2}
    one = rb.with_filter(b.equal("k", 3))
    assert len(one.new_scan().plan().splits()) == 1 and one.to_df().collect() == [(3, "new")]
    assert rb.with_filter(b.greater_than("k", 19)).new_scan().plan().splits() == []
    assert rb.between_snapshots(1, 2).to_df().count() == 5
    t.compact()
    assert t.to_df().count() == 20 and sum(s.row_count() for s in rb.new_scan().plan().splits()) == 20
    assert t.expire_snapshots(1) == 2 and t.to_df().filter("v = 'new'").count() == 5
    t.add_column("w", "int")
    u = catalog.get_table("d.versions")
    assert u.to_df().columns == ["k", "v", "w"] and u.to_df().filter("w IS NULL").count() == 20
    with pytest.raises(ValueError):
        u.add_column("w", "int")
    many = make(catalog, "many", [("x", pa.int32())])
    from tablekit.sources import snapshot

    for i in range(4):
        put(many, pa.schema([("x", pa.int32())]), [(i,)])
    snapshot.MOST_MANIFESTS, before = 2, snapshot.MOST_MANIFESTS
    try:
        put(many, pa.schema([("x", pa.int32())]), [(9,)])
    finally:
        snapshot.MOST_MANIFESTS = before
    assert len(many.snapshots.latest().manifests) == 2 and rows_of(many.to_df()) == [(0,), (1,), (2,), (3,), (9,)]
    rb = many.new_read_builder()
    assert len(rb.with_filter(rb.new_predicate_builder().equal("x", 9)).new_scan().plan().splits()[0].files) == 1


def test_entry_imports_without_a_session():
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(__file__).parents[1]
    found = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries().keys() >= e.oracle_sql().keys()"], cwd=root, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
