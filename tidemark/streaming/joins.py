"""Joins of two streams: impressions and the clicks that follow them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import interval_join, within_interval


def event_time(df: DataFrame, column: str, delay: str | None = None) -> DataFrame:
    """Give a stream its event time, and a watermark if rows may be ``delay`` late. Watermarks
    need a TIMESTAMP, so a timestamp without zone is cast."""
    typed = df.withColumn(column, F.col(column).cast("timestamp"))
    return typed if delay is None else typed.withWatermark(column, delay)


def join_on_key(impressions: DataFrame, clicks: DataFrame, key: str) -> DataFrame:
    """Inner join without time bounds: every row stays in state for good."""
    return impressions.join(clicks, key)


def join_in_range(
    impressions: DataFrame,
    clicks: DataFrame,
    impression_key: str,
    click_key: str,
    impression_time: str,
    click_time: str,
    length: timedelta,
    how: str = "inner",
    spread: bool = True,
) -> DataFrame:
    """Clicks within ``length`` after their impression.

    With watermarks on both sides the range lets Spark drop state that can match no more. With
    ``how="leftOuter"`` an impression without click leaves with nulls once its range has passed;
    Spark refuses that form without the watermarks.

    ``spread`` divides the state of a hot key over tasks by time slots (see
    :func:`tidemark.operators.joins.interval_join`). An impression is held once, in its slot, so an outer
    join reports it once; a click is held in two.
    """
    if spread:
        return interval_join(
            impressions, clicks, impression_key, click_key, impression_time, click_time, length, how
        )
    same_ad = F.col(impression_key) == F.col(click_key)
    in_time = within_interval(F.col(impression_time), F.col(click_time), length)
    return impressions.join(clicks, same_ad & in_time, how)
