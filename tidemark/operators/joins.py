"""Membership and interval joins that do not shuffle the large side for a small one."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import KeySpec, key_pairs, private, quoted
from .sizing import BROADCAST_BYTES, is_small


def differs(columns: Sequence[str], left: str, right: str) -> Column:
    """Any of the columns differs, where null differs from every value and equals null."""
    return reduce(
        or_,
        (~F.col(f"{left}.{quoted(c)}").eqNullSafe(F.col(f"{right}.{quoted(c)}")) for c in columns),
    )


def same_key(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(and_, (F.col(f"{left}.{quoted(k)}") == F.col(f"{right}.{quoted(k)}") for k in keys))


def semi_join(
    rows: DataFrame, table: DataFrame, on: KeySpec, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows whose key occurs in ``table``."""
    return _by_membership(rows, table, on, "left_semi", broadcast_bytes)


def anti_join(
    rows: DataFrame, table: DataFrame, on: KeySpec, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows whose key does not occur in ``table``; a null key occurs nowhere."""
    return _by_membership(rows, table, on, "left_anti", broadcast_bytes)


def _by_membership(rows: DataFrame, table: DataFrame, on: KeySpec, how: str, broadcast_bytes: int) -> DataFrame:
    pairs = key_pairs(on, rows.columns, table.columns)
    small = is_small(rows.select(*(quoted(a) for a, _ in pairs)), broadcast_bytes)
    return join_members(rows, table, pairs, how, small)


def join_members(
    rows: DataFrame, table: DataFrame, pairs: Sequence[tuple[str, str]], how: str, small: bool
) -> DataFrame:
    """Semi or anti join of ``rows`` with the keys of ``table``; ``pairs`` of key columns.

    If the rows are small, their keys are broadcast to the table's scan, which is not shuffled;
    the distinct keys that pass are no larger than the rows and are broadcast in turn.

    Otherwise the table's keys are made distinct, which takes a hot key out of it before the
    shuffle. The second condition of the join follows from the first. It makes Spark shuffle both
    sides for the join itself, which is what adaptive execution needs to split a hot key of
    ``rows``.

    Keys of two types are compared as their common type, in both forms: equal values of two types
    have different hashes.
    """
    kinds = [common_type(rows, a, table, b) for a, b in pairs]
    keys = [_comparable(F.col(f"r.{quoted(a)}"), rows.schema[a].dataType, k) for (a, _), k in zip(pairs, kinds)]
    known = table.select(
        *(
            _comparable(F.col(quoted(b)), table.schema[b].dataType, k).alias(f"k{i}")
            for i, ((_, b), k) in enumerate(zip(pairs, kinds))
        )
    )
    known_keys = [F.col(f"k.k{i}") for i in range(len(pairs))]
    equal = reduce(and_, (a == b for a, b in zip(keys, known_keys)))
    if small:
        wanted = rows.select(*(quoted(a) for a, _ in pairs)).alias("r")
        known = known.alias("k").join(F.broadcast(wanted), equal, "left_semi").distinct()
        return rows.alias("r").join(F.broadcast(known).alias("k"), equal, how)
    return rows.alias("r").join(
        known.distinct().alias("k"), equal & (F.xxhash64(*keys) == F.xxhash64(*known_keys)), how
    )


def common_type(left: DataFrame, a: str, right: DataFrame, b: str) -> T.DataType:
    """The type as which Spark compares column ``a`` of one relation with ``b`` of the other."""
    kinds = [left.schema[a].dataType, right.schema[b].dataType]
    if kinds[0] == kinds[1]:
        return kinds[0]
    nulls = [F.lit(None).cast(k).alias(n) for k, n in zip(kinds, "ab")]
    return left.sparkSession.range(0).select(*nulls).select(F.coalesce("a", "b").alias("c")).schema["c"].dataType


def _comparable(key: Column, own: T.DataType, common: T.DataType) -> Column:
    """A key as the common type; of the two zeros of a floating type only one is left."""
    typed = key if own == common else key.cast(common)
    return typed + F.lit(0).cast(common) if isinstance(common, (T.FloatType, T.DoubleType)) else typed


def within_interval(start: Column, instant: Column, length: timedelta) -> Column:
    """``instant`` lies in ``[start, start + length]``."""
    return (instant >= start) & (instant <= start + F.lit(length))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    start: str,
    instant: str,
    length: timedelta,
    how: str = "inner",
) -> DataFrame:
    """Rows of equal key whose ``instant`` lies within ``length`` after ``start``; with
    ``how="left"`` also left rows without a partner.

    Time is cut into slots of that length and the slot is part of the join key, so that a key with
    very many rows is spread over tasks and is compared with its neighbours in time only. A left
    row is in the slot of its start alone. A right row goes to each slot in which an interval that
    holds it can start (two, as a rule). So every pair meets once, and a left row without a partner is
    reported once.

    Whole days of ``length`` are days of the session's calendar, as in Spark's own interval arithmetic, so that
    an interval over a clock change is an hour longer or shorter than its slot; lengths of a day and more
    therefore look one slot further back. Both sides may be dates, or timestamps with or without zone; two
    different ones are compared as timestamps with zone.
    """
    kinds = {left.schema[start].dataType, right.schema[instant].dataType}
    zoned = any(isinstance(k, T.TimestampType) for k in kinds) or (len(kinds) > 1 and T.StringType() in kinds)
    common = "timestamp" if zoned else "timestamp_ntz"
    slot = private([*left.columns, *right.columns], "_slot")
    micros = F.unix_micros if zoned else clock_micros

    def number(moment: Column) -> Column:
        return F.floor(micros(moment) / F.lit(length // timedelta(microseconds=1)))

    begun, at = F.col(quoted(start)).cast(common), F.col(quoted(instant)).cast(common)
    further = 1 if zoned and length >= timedelta(days=1) else 0
    slots = F.sequence(number(at - F.lit(length)) - further, number(at))
    placed = left.withColumn(slot, number(begun)).alias("l")
    touched = right.withColumn(slot, F.explode(slots)).alias("r")
    l_start, r_instant = F.col(f"l.{quoted(start)}"), F.col(f"r.{quoted(instant)}")
    if len(kinds) > 1 or T.DateType() in kinds:
        l_start, r_instant = l_start.cast(common), r_instant.cast(common)
    return placed.join(
        touched,
        (F.col(f"l.{quoted(left_key)}") == F.col(f"r.{quoted(right_key)}"))
        & (F.col(f"l.{slot}") == F.col(f"r.{slot}"))
        & within_interval(l_start, r_instant, length),
        how,
    ).drop(slot)


def clock_micros(moment: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp without zone, read off its parts: on the way
    through the session's zone, hours that a clock skips or repeats would be lost."""
    seconds = F.unix_date(moment.cast("date")).cast("long") * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60
    fraction = (F.extract(F.lit("SECOND"), moment) * 1_000_000).cast("long")
    return seconds * 1_000_000 + fraction
