"""Streams over the event table: every event is an impression, click events refer to the
impression fifty events earlier, which is how clicks come late."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.ads import CLICK_DELAY, CLICK_LAG, IMPRESSION_DELAY, occurrences
from ..operators.joins import clock_micros
from ..session import materialize
from ..sources.files import table
from ..streaming.joins import event_time, join_in_range, join_on_key
from ..streaming.sinks import Run, run_available, run_batches
from ..streaming.sources import parquet_table, replayed
from .registry import query

_STREAMS_SQL = f"""
WITH impressions AS (SELECT event_id AS impression_ad, ts AS impression_time FROM events),
clicks AS (
  SELECT event_id - {CLICK_LAG} AS click_ad, ts AS click_time FROM events
  WHERE event_type = 'click' AND event_id - {CLICK_LAG} > 0
)"""

_IN_RANGE_SQL = """click_ad = impression_ad AND click_time >= impression_time
 AND click_time <= impression_time + INTERVAL 3 HOUR"""


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = parquet_table(spark, sf_dir, "events")
    return events.selectExpr("event_id AS value", "ts AS timestamp", "event_type")


def _joined_in_range(spark: SparkSession, sf_dir: str, how: str, label: str) -> DataFrame:
    ticks = _ticks(spark, sf_dir)
    joined = join_in_range(
        occurrences(ticks, "impression", IMPRESSION_DELAY),
        occurrences(ticks.where("event_type = 'click'"), "click", CLICK_DELAY, CLICK_LAG),
        "impression_ad",
        "click_ad",
        "impression_time",
        "click_time",
        timedelta(hours=3),
        how,
    )
    return _without_zone(run_available(joined, label))


def _without_zone(df: DataFrame) -> DataFrame:
    times = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@query("stream_scan", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of the table, once each, through a streaming query."""
    events = parquet_table(spark, sf_dir, "events")
    return run_available(events.select("event_id", "ts", "user_id", "event_type", "value"), "scan")


@query(
    "stream_join_inner",
    f"""{_STREAMS_SQL}
SELECT impression_ad AS ad_id, impression_time, click_time
FROM impressions JOIN clicks ON impression_ad = click_ad""",
)
def stream_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with their impression, whenever they come."""
    ticks = _ticks(spark, sf_dir)
    joined = join_on_key(
        occurrences(ticks, "impression").withColumnRenamed("impression_ad", "ad_id"),
        occurrences(ticks.where("event_type = 'click'"), "click", lag=CLICK_LAG).withColumnRenamed("click_ad", "ad_id"),
        "ad_id",
    )
    return _without_zone(run_available(joined, "inner"))


@query(
    "stream_join_range",
    f"""{_STREAMS_SQL}
SELECT impression_ad, impression_time, click_ad, click_time
FROM impressions JOIN clicks ON {_IN_RANGE_SQL}""",
)
def stream_join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks that come in time."""
    return _joined_in_range(spark, sf_dir, "inner", "range")


@query(
    "stream_join_left_outer",
    f"""{_STREAMS_SQL}, joined AS (
  SELECT * FROM impressions LEFT JOIN clicks ON {_IN_RANGE_SQL}
), watermark AS (
  SELECT LEAST((SELECT MAX(impression_time) FROM impressions) - INTERVAL 10 SECOND,
               (SELECT MAX(click_time) FROM clicks) - INTERVAL 20 SECOND) AS w
)
SELECT impression_ad, impression_time, click_ad, click_time FROM joined, watermark
WHERE click_ad IS NOT NULL OR impression_time + INTERVAL 3 HOUR < w""",
)
def stream_join_left_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also impressions without a click, once the watermark says that none can come; those still
    open at the end of the input stay in state."""
    return _joined_in_range(spark, sf_dir, "leftOuter", "outer")


# --- several micro-batches, with rows that come too late ----------------------------------------

_ORDERED_BATCHES = 6


def run_late(spark: SparkSession, sf_dir: str) -> Run:
    """Events by hour and type, replayed in the order of their time in six micro-batches. Errors of the first half come in a
    seventh, when their hours are closed."""
    events = table(spark, sf_dir, "events").select("ts", "event_type").withColumn("micros", clock_micros(F.col("ts")))
    events = materialize(events, "events")
    first, last = events.agg(F.min("micros"), F.max("micros")).first()
    late = (F.col("event_type") == "error") & (2 * F.col("micros") < first + last)
    ordered = F.floor((F.col("micros") - first) * _ORDERED_BATCHES / (last - first + 1))
    stream = replayed(events, F.when(late, _ORDERED_BATCHES).otherwise(ordered), _ORDERED_BATCHES + 1)
    timed = event_time(stream, "ts", "1 hour")
    counts = timed.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("num_events"))
    return run_batches(counts.select(F.col("w.start").alias("hour"), "event_type", "num_events"), "late")


@query(
    "stream_late_rows",
    """WITH span AS (SELECT epoch_us(MIN(ts)) + epoch_us(MAX(ts)) AS ends FROM events),
on_time AS (SELECT ts, event_type FROM events, span WHERE NOT (event_type = 'error' AND 2 * epoch_us(ts) < ends) OR event_type IS NULL)
SELECT date_trunc('hour', ts) AS hour, event_type, COUNT(*) AS num_events FROM on_time
GROUP BY date_trunc('hour', ts), event_type
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM on_time) - INTERVAL 1 HOUR""",
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed hours without the rows that came after the watermark."""
    return _without_zone(run_late(spark, sf_dir).table)
