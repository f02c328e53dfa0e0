from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidemark.operators.joins import anti_join, interval_join, semi_join
from tidemark.operators.scd2 import matching_versions
from tidemark.operators.sizing import broadcast_if_small, is_small, total_bytes


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_membership(spark, limit):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,), (3,), (None,)], "K int")
    assert rows(semi_join(left, right, "k", limit)) == [(1, "a"), (1, "b")]
    assert rows(anti_join(left, right, "k", limit)) == [(2, "c"), (None, "d")]


KEY_TYPES = [
    ("int", "long", "1", "2", "9"),
    ("decimal(10,2)", "decimal(12,4)", "1.50", "2.25", "9"),
    ("date", "timestamp", "'2024-01-01'", "'2024-01-02'", "'2024-01-09'"),
    ("int", "double", "1", "2", "9"),
    ("string", "string", "'a'", "'b'", "'z'"),
    ("double", "double", "0.0D", "2.0D", "9"),
]


@pytest.mark.parametrize("limit", [0, 1 << 20])
@pytest.mark.parametrize("one, other, a, b, z", KEY_TYPES)
def test_membership_across_types(spark, limit, one, other, a, b, z):
    zero = "-0.0D" if a == "0.0D" else a  # both zeros are one key
    left = spark.sql(f"SELECT CAST(x AS {one}) AS k, n FROM VALUES ({a}, 1), ({b}, 2) AS v(x, n)")
    right = spark.sql(f"SELECT CAST(x AS {other}) AS k FROM VALUES ({zero}), ({z}) AS v(x)")
    assert [r["n"] for r in semi_join(left, right, "k", limit).collect()] == [1]
    assert [r["n"] for r in anti_join(left, right, "k", limit).collect()] == [2]
    assert semi_join(right, left, "k", limit).count() == anti_join(right, left, "k", limit).count() == 1


def test_hot_key_of_the_rows_is_split(spark, tmp_path, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
    )
    spark.range(0, 60000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "uuid() AS v"
    ).write.parquet(f"{tmp_path}/rows")
    hot = spark.read.parquet(f"{tmp_path}/rows")
    keys = spark.range(0, 60000, 1, 8).selectExpr("id AS k").where("k % 2 = 1")
    for result in (semi_join(hot, keys, "k", 0), matching_versions(hot, keys, "k", 0)):
        assert len(result.collect()) == hot.where("k % 2 = 1").count()
        assert "skew=true" in plan(result)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_interval_join_against_brute_force(spark, conf, kind, zone):
    """One hot key, all moments near slot borders, across a change to daylight saving time."""
    conf(spark__sql__session__timeZone=zone)
    left = spark.range(0, 60).selectExpr(
        "id AS l", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k",
        f"cast(TIMESTAMP '2024-03-09 20:00:00' + make_dt_interval(0, 0, 10 * id) AS {kind}) AS shown",
    )
    right = spark.range(0, 60).selectExpr(
        "id AS r", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS key",
        f"cast(TIMESTAMP '2024-03-09 20:15:00' + make_dt_interval(0, 0, 15 * id) AS {kind}) AS clicked",
    )
    for length in (timedelta(minutes=30), timedelta(hours=2), timedelta(days=1)):
        got = interval_join(left, right, "k", "key", "shown", "clicked", length)
        assert got.columns == ["l", "k", "shown", "r", "key", "clicked"]
        end = F.col("shown") + F.lit(length)
        plain = left.join(right, F.expr("k = key AND clicked >= shown") & (F.col("clicked") <= end))
        assert rows(got) == rows(plain) and not plain.isEmpty()


@pytest.mark.parametrize("day", ["2024-03-10", "2024-11-03"])
@pytest.mark.parametrize("minutes", [7, 11, 45])
def test_interval_join_without_zone_across_both_clock_changes(spark, conf, day, minutes):
    """A grid of minutes around the hour that is skipped or repeated where the session is."""
    conf(spark__sql__session__timeZone="America/New_York")
    moments = spark.range(0, 240).selectExpr(
        "1 AS k", f"TIMESTAMP_NTZ '{day} 00:00:00' + make_dt_interval(0, 0, id) AS at"
    )
    left, right = moments.toDF("k", "shown"), moments.toDF("key", "clicked")
    got = interval_join(left, right, "k", "key", "shown", "clicked", timedelta(minutes=minutes))
    assert got.count() == sum(min(minutes, 239 - i) + 1 for i in range(240))


def test_left_interval_join(spark):
    left = spark.range(0, 40).selectExpr("1 AS k", "TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, 5 * id) AS shown")
    right = spark.range(0, 9).selectExpr("1 AS key", "TIMESTAMP '2024-01-01 00:02:00' + make_dt_interval(0, 0, 20 * id) AS clicked")
    got = interval_join(left, right, "k", "key", "shown", "clicked", timedelta(minutes=7), "left")
    end = F.col("shown") + F.expr("INTERVAL 7 MINUTE")
    plain = left.join(right, F.expr("k = key AND clicked >= shown") & (F.col("clicked") <= end), "left")
    assert rows(got) == rows(plain) and not plain.where("clicked IS NULL").isEmpty()


def test_size_bound(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "k int, v string")
    assert total_bytes(df) == 2 * 48 + 2
    assert is_small(df, 98) and not is_small(df, 97)
    assert "BroadcastHashJoin" in plan(df.alias("a").join(broadcast_if_small(df), "k"))


def test_unbounded_types_are_never_small(spark):
    df = spark.createDataFrame([([1, 2],)], "v array<int>")
    assert total_bytes(df) is None
    assert not is_small(df, 1 << 40)


@pytest.mark.parametrize("zone, day", [
    ("Europe/Berlin", "2024-03-30"), ("Europe/Berlin", "2024-10-26"), ("Asia/Jerusalem", "2024-03-28"),
    ("America/New_York", "2024-11-02"), ("Australia/Lord_Howe", "2024-10-05"),
])
@pytest.mark.parametrize("hours", [24, 25, 26.5, 30, 37, 48])
def test_interval_join_of_days_across_clock_changes(spark, conf, zone, day, hours):
    """A grid of 20 minutes over the change; whole days are those of the session's calendar."""
    conf(spark__sql__session__timeZone=zone)
    moments = spark.range(0, 216).selectExpr("1 AS k", f"TIMESTAMP '{day} 00:00:00' + make_dt_interval(0, 0, 20 * id) AS at")
    left, right = moments.toDF("k", "shown"), moments.toDF("key", "clicked")
    length = timedelta(hours=hours)
    plain = left.join(right, F.expr("k = key AND clicked >= shown") & (F.col("clicked") <= F.col("shown") + F.lit(length)))
    assert interval_join(left, right, "k", "key", "shown", "clicked", length).count() == plain.count()


def test_interval_join_of_dates_and_of_two_types(spark):
    days = spark.range(0, 40).selectExpr("1 AS k", "date_add(DATE '2024-02-20', cast(id AS int)) AS at", "id AS _slot")
    left, right = days.toDF("k", "shown", "_slot"), days.toDF("key", "clicked", "_SLOT_")
    got = interval_join(left, right, "k", "key", "shown", "clicked", timedelta(days=3))
    assert got.columns == ["k", "shown", "_slot", "key", "clicked", "_SLOT_"]
    assert got.count() == sum(min(3, 39 - i) + 1 for i in range(40))
    zoned = right.withColumn("clicked", F.col("clicked").cast("timestamp"))
    assert interval_join(left, zoned, "k", "key", "shown", "clicked", timedelta(days=3)).count() == got.count()
