"""Occurrences out of a stream of ``(value, timestamp)`` ticks, such as the rate source gives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import event_time

# How late each stream may be, and how many ticks a click lags its impression.
IMPRESSION_DELAY = "10 seconds"
CLICK_DELAY = "20 seconds"
CLICK_LAG = 50


def occurrences(ticks: DataFrame, kind: str, delay: str | None = None, lag: int = 0) -> DataFrame:
    """Each tick as an occurrence of some kind, in columns ``<kind>_ad`` and ``<kind>_time``.

    It concerns the advertisement of the tick ``lag`` ticks before; a tick that has none before it is
    no occurrence. ``delay`` gives the stream a watermark.
    """
    named = ticks.select(
        (F.col("value") - lag).alias(f"{kind}_ad"), F.col("timestamp").alias(f"{kind}_time")
    )
    known = named.where(F.col(f"{kind}_ad") > 0) if lag else named
    return event_time(known, f"{kind}_time", delay)
