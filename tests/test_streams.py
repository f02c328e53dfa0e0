import datetime
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.streaming.ads import CLICK_DELAY, CLICK_LAG, IMPRESSION_DELAY, occurrences
from tidemark.streaming.joins import event_time, join_in_range
from tidemark.streaming.sinks import run_available
from tidemark.streaming.sources import rate

MINUTE = datetime.timedelta(minutes=1)
START = datetime.datetime(2024, 1, 1)
IMPRESSIONS = "ad long, shown timestamp_ntz"
CLICKS = "click_ad long, clicked timestamp_ntz"


@pytest.fixture(autouse=True)
def narrow(conf):
    conf(spark__sql__shuffle__partitions="2")


def stream_of(spark, path, batches, schema):
    """One file per batch, read in order."""
    for i, batch in enumerate(batches):
        data = spark.createDataFrame([(ad, START + m * MINUTE) for ad, m in batch], schema)
        data.coalesce(1).write.mode("append").parquet(f"{path}/{i}")
        for name in os.listdir(f"{path}/{i}"):
            if name.endswith(".parquet"):
                os.utime(f"{path}/{i}/{name}", (1000 + 10 * i, 1000 + 10 * i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def ads(df):
    return sorted(tuple(r) for r in df.select("ad", "click_ad").collect())


def sides(spark, tmp_path, shown, clicked, watermarks=True):
    left = stream_of(spark, tmp_path / "i", shown, IMPRESSIONS)
    right = stream_of(spark, tmp_path / "c", clicked, CLICKS)
    delays = ("10 seconds", "20 seconds") if watermarks else (None, None)
    return event_time(left, "shown", delays[0]), event_time(right, "clicked", delays[1])


def joined(left, right, how, spread=True):
    return join_in_range(left, right, "ad", "click_ad", "shown", "clicked", MINUTE, how, spread)


def test_late_rows_are_dropped(spark, tmp_path):
    """The third batch brings a pair that the watermark has passed for good."""
    batches = [[(1, 0)], [(2, 60)], [(3, 120)], [(4, 1), (5, 180)]]
    left, right = sides(spark, tmp_path, batches, batches)
    result = run_available(joined(left, right, "inner"), "late")
    assert [a for a, _ in ads(result)] == [1, 2, 3, 5]


@pytest.mark.parametrize("spread", [False, True])
def test_left_outer_emits_unmatched_after_the_watermark(spark, tmp_path, spread):
    impressions = [[(1, 0), (2, 0)], [(3, 60)], [(4, 120)]]
    clicks = [[(1, 0.5)], [(3, 62)], [(4, 120)]]
    left, right = sides(spark, tmp_path, impressions, clicks)
    result = run_available(joined(left, right, "leftOuter", spread), "outer")
    # ad 2 had no click, the click of ad 3 came too late; ad 4 matched at once
    assert ads(result) == [(1, 1), (2, None), (3, None), (4, 4)]


def test_spread_join_gives_the_same_rows_and_frees_its_state(spark, tmp_path):
    """Every advertisement is the same: one key, whose state is divided by time."""
    shown = [[(1, 0), (1, 0.25)], [(1, 10), (1, 10.5)], [(1, 600)], [(1, 601)]]
    clicked = [[(1, 0.5), (1, 1.1)], [(1, 11.25)], [(1, 600.5)], [(1, 601)]]
    results = []
    for spread in (False, True):
        left, right = sides(spark, tmp_path / str(spread), shown, clicked)
        joined = join_in_range(left, right, "ad", "click_ad", "shown", "clicked", MINUTE, spread=spread)
        results.append(rows(run_available(joined, f"spread-{spread}").select("shown", "clicked")))
        query = joined.writeStream.format("noop").trigger(availableNow=True)
        query = query.option("checkpointLocation", str(tmp_path / f"state-{spread}")).start()
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= (6 if spread else 4)
    assert results[0] == results[1] and len(results[0]) == 7


def test_outer_join_needs_watermarks(spark, tmp_path):
    left, right = sides(spark, tmp_path, [[(1, 0)]], [[(1, 0)]], watermarks=False)
    with pytest.raises(AnalysisException):
        run_available(joined(left, right, "leftOuter"), "refused")


def test_watermark_needs_a_zoned_timestamp(spark, tmp_path):
    stream = stream_of(spark, tmp_path / "i", [[(1, 0)]], IMPRESSIONS)
    with pytest.raises(AnalysisException):
        stream.withWatermark("shown", "10 seconds").groupBy("shown").count().schema


def test_rate(spark):
    clicks = rate(spark, rows_per_second=50).where("value % 10 = 0").selectExpr("value AS ad", "timestamp AS clicked")
    assert clicks.isStreaming
    query = clicks.writeStream.format("memory").queryName("rate_test").start()
    try:
        for _ in range(40):
            query.awaitTermination(1)
            if spark.table("rate_test").count() > 5:
                break
    finally:
        query.stop()
    got = sorted(r["ad"] for r in spark.table("rate_test").collect())
    assert got == [10 * i for i in range(len(got))] and len(got) > 5


def test_clicks_on_rate_streams(spark):
    """Two generated streams, joined in range, on the clock of this machine."""
    ticks = rate(spark, rows_per_second=20)
    shown = occurrences(ticks, "impression", IMPRESSION_DELAY)
    every_fifth = rate(spark, rows_per_second=20).where("value % 5 = 0")
    clicked = occurrences(every_fifth, "click", CLICK_DELAY, lag=CLICK_LAG // 5)
    result = join_in_range(
        shown, clicked, "impression_ad", "click_ad", "impression_time", "click_time", MINUTE
    )
    query = result.writeStream.format("memory").queryName("rate_join").start()
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if spark.table("rate_join").count() > 3:
                break
    finally:
        query.stop()
    got = spark.table("rate_join").collect()
    assert len(got) > 3
    assert all(r["impression_ad"] == r["click_ad"] and r["click_ad"] % 5 == 0 for r in got)
    assert all(r["impression_time"] <= r["click_time"] <= r["impression_time"] + MINUTE for r in got)


def test_random_click_sample_is_a_streaming_filter(spark):
    sampled = rate(spark).where((F.rand() * 100).cast("int") < 10)
    assert sampled.isStreaming and sampled.columns == ["timestamp", "value"]


def test_late_rows_in_several_batches(spark):
    """Six batches in order and one of late rows; state stays below the table."""
    from tidemark.plans.streams import run_late

    sf_dir = "/root/testdata/sf0.01"
    run = run_late(spark, sf_dir)
    assert run.batches == 7 and run.dropped > 0
    assert run.most_state < spark.read.parquet(f"{sf_dir}/events.parquet").count() / 2
