import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan, rows
from tidemark.operators.numbering import _bounds, _with_range, number_new_rows, with_row_number


def plain(df, order, name, start):
    window = Window.orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return df.withColumn(name, (F.row_number().over(window) + start - 1).cast("long"))


@pytest.mark.parametrize("rows_per_range", [50, 700, 10**6])
def test_equals_one_window_over_all_rows(spark, rows_per_range):
    """A third of the ids is null and a third is one value."""
    df = spark.range(0, 6000, 1, 8).selectExpr(
        "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 77 ELSE cast(hash(id) % 500 AS int) END AS id",
        "concat('n', id) AS name",
    )
    numbered = with_row_number(df, ["id", "name"], "nr", rows_per_range=rows_per_range)
    assert rows(numbered) == rows(plain(df, ["id", "name"], "nr", 0))


def test_hot_first_column_is_cut_by_the_next_one(spark):
    df = spark.range(0, 8000, 1, 8).selectExpr("CASE WHEN id % 2 = 0 THEN NULL ELSE id END AS a", "id AS b")
    counts = _with_range(df, ["a", "b"], _bounds(df, ["a", "b"], 500)).groupBy("_range").count()
    assert counts.agg(F.max("count")).first()[0] < 2000


def test_copies_of_one_row_are_cut_too(spark):
    df = spark.range(0, 9000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS a", "'x' AS b")
    numbered = with_row_number(df, ["a"], "nr", rows_per_range=500)
    assert numbered.columns == ["a", "b", "nr"]
    assert rows(numbered) == rows(plain(df, ["a"], "nr", 0))
    window = [n for n in plan(numbered).splitlines() if "Window [row_number()" in n]
    assert window and "_read" in window[0]


def test_other_types_and_start(spark):
    df = spark.range(0, 3000, 1, 4).selectExpr(
        "date_add(DATE '2020-01-01', cast(id % 40 AS int)) AS day",
        "cast(id % 7 AS double) AS x",
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS moment",
    )
    order = ["day", "x", "moment"]
    numbered = with_row_number(df, order, "nr", start=1, rows_per_range=100)
    assert rows(numbered) == rows(plain(df, order, "nr", 1))


def test_moments_around_the_end_of_daylight_saving_time(spark, conf):
    conf(spark__sql__session__timeZone="America/New_York")
    df = spark.range(0, 3000, 1, 4).selectExpr("timestamp_seconds(1730600000 + id * 7) AS moment", "id")
    numbered = with_row_number(df, ["moment"], "nr", rows_per_range=50)
    assert all(r["id"] == r["nr"] for r in numbered.select("id", "nr").collect())


def test_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(0, 5000).selectExpr("hash(id) AS a", "id AS b")
    one = with_row_number(df.repartition(3), ["a", "b"], "nr", rows_per_range=300)
    two = with_row_number(df.repartition(11), ["a", "b"], "nr", rows_per_range=300)
    assert rows(one) == rows(two)


def test_empty(spark):
    assert with_row_number(spark.range(0), ["id"], "nr").isEmpty()


def test_columns_of_the_user_come_back(spark):
    """Every name that numbering uses between its steps."""
    names = ["_tie", "_range", "_read", "_rows", "_before"]
    df = spark.range(0, 3000, 1, 4).selectExpr("id % 40 AS id", *(f"concat('{n}', id % 40) AS `{n}`" for n in names))
    numbered = with_row_number(df, ["id"], "nr", rows_per_range=100)
    assert numbered.columns == ["id", *names, "nr"]
    assert rows(numbered.select("id", "nr")) == rows(plain(df, ["id"], "nr", 0).select("id", "nr"))
    assert rows(numbered.drop("nr")) == rows(df)


@pytest.mark.parametrize("rows_per_range", [60, 10**6])
def test_new_rows_are_numbered_after_known_ones(spark, rows_per_range):
    df = spark.range(0, 1500, 1, 4).selectExpr("CASE WHEN id % 3 > 0 THEN 5000 - id END AS nr", "concat('n', id) AS name")
    got = number_new_rows(df, "nr", ["name"], rows_per_range=rows_per_range)
    names = sorted(r["name"] for r in df.where("nr IS NULL").collect())
    expected = {r["name"]: r["nr"] for r in df.where("nr IS NOT NULL").collect()} | {n: 5000 + i for i, n in enumerate(names)}
    assert got.columns == df.columns and {r["name"]: r["nr"] for r in got.collect()} == expected
    assert [r["nr"] for r in number_new_rows(df.where("name = 'n0'"), "nr", ["name"], start=7).collect()] == [7]


def test_known_rows_are_not_sorted(spark, tmp_path):
    spark.range(0, 4000, 1, 4).selectExpr("CASE WHEN id % 50 > 0 THEN id END AS nr", "id AS k").write.parquet(f"{tmp_path}/t")
    numbered = plan(number_new_rows(spark.read.parquet(f"{tmp_path}/t"), "nr", ["k"], rows_per_range=20))
    known, fresh = numbered.split("Union")[-1].split("FileScan")[0:2]
    assert "Sort" not in known.split("+- ")[1] and "isnotnull(nr" in numbered


def test_maps_inside_structs_break_ties(spark):
    df = spark.range(0, 6).selectExpr("1 AS a", "named_struct('m', map('x', id, 'y', id + 1)) AS s")
    assert sorted(r["nr"] for r in with_row_number(df, ["a"], "nr", rows_per_range=2).collect()) == list(range(6))
