"""Versions, schema rules, write modes, mutation, row hashes."""

import datetime

import pytest
from pyspark.errors import AnalysisException, NumberFormatException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan, rows
from tidemark.operators import writes
from tidemark.operators.mutate import delete_all, delete_where, update_where
from tidemark.operators.rows import changed_rows, hash_of, sample_by_key, sample_random, with_row_hash, with_tracking
from tidemark.operators.schema import SchemaMismatch, conform, enforce, union_evolving
from tidemark.operators.versions import as_of, commit, history, read_version, write_version
from tidemark.session import materialize, new_path, shared_root

AT = [datetime.datetime(2022, 1, d) for d in (1, 2, 3)]


@pytest.fixture
def log(spark):
    table = "k int, v string"
    return (
        commit(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], table), 0, AT[0], "insert")
        .union(commit(spark.createDataFrame([(1, "A")], table), 1, AT[1], "update"))
        .union(commit(spark.createDataFrame([(2, "b")], table), 1, AT[1], "delete"))
        .union(commit(spark.createDataFrame([(2, None)], table), 2, AT[2], "insert"))
    )


def test_as_of(log):
    first = [(1, "a"), (2, "b"), (None, "n")]
    second = [(1, "A"), (None, "n")]
    assert rows(as_of(log, ["k"], version=0)) == first
    assert rows(as_of(log, ["k"], version=1)) == second
    assert rows(as_of(log, ["k"], timestamp=AT[1] + datetime.timedelta(hours=1))) == second
    assert rows(as_of(log, ["k"], timestamp=AT[0])) == first
    assert rows(as_of(log, ["k"])) == [(1, "A"), (2, None), (None, "n")]


def test_as_of_before_the_first_commit(log):
    with pytest.raises(ValueError, match="no commit"):
        as_of(log, ["k"], timestamp=datetime.datetime(2021, 1, 1))
    with pytest.raises(ValueError, match="not both"):
        as_of(log, ["k"], version=0, timestamp=AT[0])


def test_history(log):
    assert rows(history(log)) == [(0, AT[0], 3, 0, 0), (1, AT[1], 0, 1, 1), (2, AT[2], 1, 0, 0)]


def test_next_version_may_read_the_last_one(spark, tmp_path):
    root = str(tmp_path / "table")
    write_version(spark.range(5).union(spark.range(5)), root, 0)
    write_version(read_version(spark, root, 0).distinct(), root, 1)
    assert read_version(spark, root, 1).count() == 5
    assert read_version(spark, root, 0).count() == 10
    with pytest.raises(AnalysisException):
        write_version(spark.range(1), root, 1)


PERSON = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType(), False)])


def test_enforce(spark):
    good = spark.createDataFrame([("h", 50), ("s", 46)], "name string, age int")
    assert rows(enforce(good, PERSON)) == [("h", 50), ("s", 46)]
    assert enforce(good.select("age", "name"), PERSON).columns == ["name", "age"]
    with pytest.raises(SchemaMismatch, match="age is string"):
        enforce(spark.createDataFrame([("h", "50")], "name string, age string"), PERSON)
    with pytest.raises(SchemaMismatch, match="nulls in required columns: {'age': 1}"):
        enforce(spark.createDataFrame([("h", 50), ("s", None)], "name string, age int"), PERSON)
    with pytest.raises(SchemaMismatch, match="missing column age; |unexpected column"):
        enforce(spark.createDataFrame([("h", "red")], "name string, color string"), PERSON)


def test_conform(spark):
    loose = spark.createDataFrame([("7", "x"), ("", "y"), ("1.5", "z"), (" 8 ", "w")], "AGE string, extra string")
    assert [r["age"] for r in conform(loose, PERSON).collect()] == [7, None, None, 8]
    assert conform(loose, PERSON).columns == ["name", "age"]


def test_lenient_union_needs_conform(spark):
    numbers = spark.createDataFrame([(1,)], "active int")
    texts = spark.createDataFrame([("",)], "active string")
    with pytest.raises(NumberFormatException):
        numbers.union(texts).collect()
    assert rows(numbers.unionByName(conform(texts, numbers.schema))) == [(1,), (None,)]


def test_append(spark, tmp_path):
    path = str(tmp_path / "people")
    writes.create(spark.createDataFrame([("bob", 47), ("li", 23)], "first_name string, age long"), path)
    colours = spark.createDataFrame([("sal", "red")], "first_name string, favorite_color string")
    with pytest.raises(SchemaMismatch):
        writes.append(colours, path)
    with pytest.raises(AnalysisException):
        writes.create(colours, path)
    writes.append_evolving(colours, path)
    assert rows(writes.read(spark, path)) == [("bob", 47, None), ("li", 23, None), ("sal", None, "red")]
    with pytest.raises(SchemaMismatch):
        writes.append_evolving(spark.createDataFrame([("old",)], "age string"), path)
    writes.overwrite(colours, path)
    assert rows(writes.read(spark, path)) == [("sal", "red")]


def test_union_evolving(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2.0, 2)], "b double, k int")
    assert rows(union_evolving(a, b)) == [(1, "x", None), (2, None, 2.0)]
    with pytest.raises(SchemaMismatch):
        union_evolving(a, spark.createDataFrame([("x",)], "k string"))


def test_replace_a_table_from_itself(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS writes_test")
    spark.range(5).write.mode("overwrite").saveAsTable("writes_test.numbers")
    table = spark.table("writes_test.numbers")
    writes.replace_table(table.select((F.col("id") * 2).alias("id")), "writes_test.numbers")
    assert rows(spark.table("writes_test.numbers")) == [(0,), (2,), (4,), (6,), (8,)]
    spark.sql("DROP DATABASE writes_test CASCADE")


def test_update_and_delete(spark):
    df = spark.createDataFrame([(1, 10, "a"), (2, None, "b"), (3, 30, None)], "k int, price int, kind string")
    updated = update_where(df, {"PRICE": "price * 0.5", "k": F.col("price")}, "kind = 'a'")
    assert rows(updated) == [(10, 5, "a"), (2, None, "b"), (3, 30, None)]
    assert updated.schema["price"].dataType == T.IntegerType()
    assert rows(delete_where(df, "price > 20")) == [(1, 10, "a"), (2, None, "b")]
    assert rows(delete_where(df, F.col("kind") == "a")) == [(2, None, "b"), (3, 30, None)]
    assert delete_all(df).isEmpty() and delete_all(df).schema == df.schema


def test_delete_reaches_the_scan(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/t")
    text = plan(delete_where(spark.read.parquet(f"{tmp_path}/t"), "id < 10"))
    assert "PushedFilters: [Or(GreaterThanOrEqual(id,10),IsNull(id))]" in text


def test_row_hash(spark):
    import hashlib

    df = spark.createDataFrame([(1, "a", "b"), (2, "a", None), (3, None, "a")], "k int, x string, y string")
    hashes = {r["k"]: r["h"] for r in df.select("k", hash_of(["x", "y"]).alias("h")).collect()}
    assert hashes[1] == hashlib.sha256(b"1:a1:b").hexdigest()
    assert hashes[2] != hashes[3]
    hashed = with_tracking(with_row_hash(df, ["x", "y"]))
    assert dict(hashed.dtypes)["end_date"] == "date"
    edited = hashed.withColumn("y", F.when(F.col("k") == 2, "new").otherwise(F.col("y")))
    assert [r["k"] for r in changed_rows(edited, ["x", "y"]).collect()] == [2]


def test_samples(spark):
    df = spark.range(0, 20000, 1, 8)
    one, two = sample_by_key(df, "id", 10), sample_by_key(df.repartition(3), "id", 10)
    assert rows(one) == rows(two)
    assert 1800 < one.count() < 2200
    assert 1800 < sample_random(df, 10, seed=3).count() < 2200


def test_working_data_is_under_the_shared_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x") != new_path(spark, "x")
    written = materialize(spark.range(3), "three")
    assert all(shared_root(spark) in path for path in written.inputFiles())


def test_row_hashes_do_not_collide(spark):
    """Values that run into one text, and null against a text, keep apart."""
    pairs = [("a||b", "c"), ("a", "b||c"), (None, "x"), ("<null>", "x"), ("-", "x"), ("", None), (None, ""), ("1:", "2"), ("", "1:2")]
    hashed = with_row_hash(spark.createDataFrame(pairs, "a string, b string"), ["a", "b"])
    assert hashed.select("row_key").distinct().count() == len(pairs)


def test_required_columns_of_a_table(spark, tmp_path):
    path = str(tmp_path / "strict")
    strict = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType())])
    writes.create(spark.createDataFrame([(1, "a")], strict), path)
    writes.append(spark.createDataFrame([(2, "b")], "k long, v string"), path)
    for wrong in (writes.append, writes.append_evolving):
        with pytest.raises(SchemaMismatch):
            rows_ = [(None, "c")] if wrong is writes.append else [("c",)]
            wrong(spark.createDataFrame(rows_, "k long, v string" if wrong is writes.append else "v string"), path)
    assert rows(writes.read(spark, path)) == [(1, "a"), (2, "b")]


def test_latest_rows_of_fixed_width_are_hashed(spark):
    log = commit(spark.range(5).selectExpr("id AS k", "id * 2 AS v"), 0, AT[0], "insert")
    assert "SortAggregate" not in plan(as_of(log, ["k"]))


def test_hashes_of_nested_values_do_not_collide(spark):
    values = [
        "array('a, b')", "array('a', 'b')", "array('a', NULL)", "array('a', 'null')", "array(NULL)", "array('-')", "array('')",
        "array()", "CAST(NULL AS array<string>)", "array('1:a')", "array('a', '1:b')", "array('a1:b')",
    ]
    arrays = spark.sql(" UNION ALL ".join(f"SELECT CAST({v} AS array<string>) AS v" for v in values))
    assert with_row_hash(arrays, ["v"]).select("row_key").distinct().count() == len(values)
    structs = arrays.selectExpr("named_struct('x', v, 'y', 1) AS v").union(arrays.selectExpr("named_struct('x', v, 'y', 2)"))
    structs = structs.union(spark.sql("SELECT CAST(NULL AS struct<x: array<string>, y: int>) AS v"))
    assert with_row_hash(structs, ["v"]).select("row_key").distinct().count() == 2 * len(values) + 1
    maps = spark.sql("SELECT map('a', 1, 'b', 2) AS v UNION ALL SELECT map('b', 2, 'a', 1) UNION ALL SELECT map('a', 2, 'b', 1) UNION ALL SELECT map()")
    assert with_row_hash(maps, ["v"]).select("row_key").distinct().count() == 3
    binary = spark.sql("SELECT X'FF' AS v UNION ALL SELECT X'FE' UNION ALL SELECT NULL")
    assert with_row_hash(binary, ["v"]).select("row_key").distinct().count() == 3


def test_change_inside_a_nested_value_is_found(spark):
    df = spark.range(0, 3).selectExpr("id", "named_struct('tags', array('a', 'b'), 'more', map(id, 'x')) AS s")
    hashed = with_row_hash(df, ["id", "s"])
    edited = hashed.withColumn("s", F.expr("named_struct('tags', array(if(id = 1, 'a, b', 'a'), 'b'), 'more', map(id, 'x'))"))
    assert [r["id"] for r in changed_rows(edited, ["id", "s"]).collect()] == [1]


def test_append_widens_types_and_fields(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = "id int, s struct<a: int, list: array<struct<x: float>>>, m map<string, struct<p: short>>"
    old = spark.createDataFrame([(1, (1, [(1.5,)]), {"k": (1,)}), (2, None, None)], first)
    later = "S struct<list: array<struct<y: string, x: double>>, b: string, a: bigint>, id bigint, d date"
    writes.create(old, path)
    new = spark.createDataFrame([(([("t", 0.1)], "b", 2**40), 2**33, None), (None, 5, None)], later)
    writes.append_evolving(new, path)
    table = writes.read(spark, path)
    assert table.schema.simpleString() == (
        "struct<id:bigint,s:struct<a:bigint,list:array<struct<x:double,y:string>>,b:string>,"
        "m:map<string,struct<p:smallint>>,d:date>"
    )
    found = {r["id"]: r for r in table.collect()}
    assert found[1]["s"].asDict(True) == {"a": 1, "list": [{"x": 1.5, "y": None}], "b": None}
    assert found[2**33]["s"].asDict(True) == {"a": 2**40, "list": [{"x": 0.1, "y": "t"}], "b": "b"}
    assert found[2]["s"] is None and found[5]["s"] is None and found[1]["m"]["k"]["p"] == 1
    for clash in ("id string", "s struct<a: string>", "s struct<list: array<struct<x: date>>>"):
        with pytest.raises(SchemaMismatch, match="id is|s.a is|s.list.element.x is"):
            writes.append_evolving(spark.createDataFrame([], clash), path)
    assert table.count() == 4
