"""Catalog tables replaced and merged in place, by partitions and in their own format."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidemark.operators.merge import WhenMatched, WhenNotMatched, merge
from tidemark.operators.merge_table import merge_table, touched_partitions
from tidemark.operators.writes import append, append_evolving, in_partitions, read, replace_table


@pytest.fixture
def table(spark, tmp_path):
    """Make a table of ten rows in five partitions, of which one is null."""
    made = []

    def make(form="parquet", partitions=("p",), options=None, kind="string"):
        name = f"t{len(made)}_{os.path.basename(tmp_path).replace('-', '_')}"
        p = f"cast(nullif(id % 5, 4) AS {kind})" if kind != "string" else "CASE id % 5 WHEN 0 THEN \"it's\" WHEN 1 THEN 'a=b/c' WHEN 2 THEN 'x y' WHEN 3 THEN '\\\\\\\\' END"
        df = spark.range(0, 10, 1, 2).selectExpr("id", "concat('v', id) AS v", f"{p} AS p")
        writer = df.write.format(form).options(**(options or {})).option("path", f"{tmp_path}/{name}")
        (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)
        made.append(name)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE {name}")


def files(tmp_path, name):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/{name}/**/part-*", recursive=True)}


@pytest.mark.parametrize("form", ["parquet", "orc"])
@pytest.mark.parametrize("kind", ["string", "int"])
def test_partitioned_table_is_replaced_from_itself(spark, table, form, kind):
    name = table(form, kind=kind)
    expected = rows(spark.table(name).selectExpr("id + 100 AS id", "v", "p"))
    replace_table(spark.table(name).selectExpr("id + 100", "v", "p"), name)
    assert rows(spark.table(name)) == expected
    kept = rows(spark.table(name).where("p IS NULL OR id % 5 = 2"))
    replace_table(spark.table(name).where("p IS NULL OR id % 5 = 2"), name)  # three partitions go
    assert rows(spark.table(name)) == kept
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    replace_table(spark.table(name).where("false"), name)
    assert spark.table(name).isEmpty() and spark.sql(f"SHOW PARTITIONS {name}").isEmpty()


@pytest.mark.parametrize("form, options", [("orc", {}), ("csv", {"header": "true", "sep": ";"}), ("parquet", {}), ("json", {})])
def test_formats_and_options_are_kept(spark, table, form, options):
    name = table(form, (), options)
    expected = rows(spark.table(name).selectExpr("id + 100 AS id", "v", "p"))
    replace_table(spark.table(name).selectExpr("id + 100", "v", "p"), name)
    assert rows(spark.table(name)) == expected
    provider = [r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Provider"]
    assert provider == [form]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("replaced_")]


def test_nothing_changes_when_the_rows_fail(spark, table):
    for partitions in ((), ("p",)):
        name = table(partitions=partitions)
        before = rows(spark.table(name))
        with pytest.raises(Exception, match="no such row"):
            replace_table(spark.table(name).selectExpr("if(id = 7, raise_error('no such row'), id)", "v", "p"), name)
        assert rows(spark.table(name)) == before
    with pytest.raises(ValueError, match="columns"):
        replace_table(spark.range(3), name)


@pytest.mark.parametrize("limit", [0, 1 << 26])
@pytest.mark.parametrize("kind", ["string", "int"])
def test_merge_writes_touched_partitions_only(spark, table, tmp_path, kind, limit):
    name = table(kind=kind)
    old, whole = files(tmp_path, name), spark.table(name)
    p = {r["id"]: r["p"] for r in whole.collect()}
    new_p = "new" if kind == "string" else 77
    changes = spark.createDataFrame(
        [(2, "two", p[2]), (20, "new", new_p), (4, "four", p[4]), (None, "none", p[2])], f"id long, v string, p {kind}"
    )
    clauses = ["id", [WhenMatched()], [WhenNotMatched()]]
    expected = rows(merge(whole, changes, *clauses))
    assert merge_table(changes, name, *clauses, broadcast_bytes=limit) == {"updated": 2, "inserted": 2, "kept": 2}
    assert rows(spark.table(name)) == expected
    now = files(tmp_path, name)
    same = {f for f in old if now.get(f) == old[f]}
    values = {os.path.dirname(f) for f in same}
    assert len(values) == 3 and len(same) == len([f for f in old if os.path.dirname(f) in values])


def test_merge_that_moves_rows(spark, table):
    """From a partition that is left empty into one that is not touched, whose rows stay."""
    name = table()
    target = {r["id"]: r["p"] for r in spark.table(name).collect()}
    changes = spark.createDataFrame([(0, "moved", target[1]), (5, "moved", target[1])], "id long, v string, p string")
    expected = rows(merge(spark.table(name), changes, "id", [WhenMatched()]))
    assert merge_table(changes, name, "id", [WhenMatched()]) == {"updated": 2, "inserted": 0, "kept": 0}
    assert rows(spark.table(name)) == expected and spark.sql(f"SHOW PARTITIONS {name}").count() == 4


def test_merge_that_changes_nothing_or_a_table_without_partitions(spark, table, tmp_path):
    name = table()
    old = files(tmp_path, name)
    nothing = spark.createDataFrame([(99, "x", "y")], "id long, v string, p string")
    assert merge_table(nothing, name, "id", [WhenMatched()])["updated"] == 0
    assert files(tmp_path, name) == old
    flat = table(partitions=())
    assert merge_table(nothing, flat, "id", [WhenMatched()], [WhenNotMatched()]) == {"updated": 0, "inserted": 1, "kept": 10}
    assert spark.table(flat).count() == 11


def test_other_partitions_are_not_read(spark, table):
    name = table(kind="int")
    touched = touched_partitions(spark.table(name), spark.createDataFrame([(3, "x")], "id int, v string"), "id", ["p"])
    assert [tuple(r) for r in touched] == [(3,)]
    scan = plan(in_partitions(spark.table(name), ["p"], touched))
    assert "PartitionFilters: [" in scan and "3" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_append_to_a_folder_of_others(spark, tmp_path):
    path = f"{tmp_path}/foreign"
    spark.range(3).selectExpr("id", "'a' AS v").write.parquet(path)
    spark.range(3, 5).selectExpr("id", "'a' AS v", "1 AS w").write.mode("append").parquet(path)
    append(spark.range(5, 6).selectExpr("2 AS w", "'b' AS v", "id"), path)
    append_evolving(spark.range(6, 7).selectExpr("id", "true AS flag"), path)
    assert read(spark, path).columns == ["id", "v", "w", "flag"]
    assert sorted(r["id"] for r in read(spark, path).collect()) == list(range(7))
    assert F is not None
