"""Broadcast only what has been measured."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import quoted

BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)
_VARIABLE = (T.StringType, T.BinaryType)


def row_bytes(df: DataFrame) -> Column | None:
    """Upper bound of the width of a row in Spark's binary row format, or None if a column has a
    nested type whose width is not bounded this way.

    Every field takes at most 16 bytes (value or offset, null bit, padding); strings and binaries
    add their bytes.
    """
    if not all(isinstance(f.dataType, _FIXED + _VARIABLE) for f in df.schema.fields):
        return None
    fixed = F.lit(16 * (len(df.columns) + 1)).cast("long")
    text = [
        F.coalesce(F.octet_length(F.col(quoted(f.name))), F.lit(0))
        for f in df.schema.fields
        if isinstance(f.dataType, _VARIABLE)
    ]
    return reduce(add, text, fixed)


def total_bytes(df: DataFrame) -> int | None:
    """Upper bound of the whole relation, from one aggregate over it; None if unknown."""
    width = row_bytes(df)
    if width is None:
        return None
    return df.agg(F.sum(width)).first()[0] or 0


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = total_bytes(df)
    return size is not None and size <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the measured size is within ``limit``.

    Beyond it the relation is returned as it is and Spark joins by shuffle, where adaptive
    execution splits skewed partitions.
    """
    return F.broadcast(df) if is_small(df, limit) else df


@dataclass(frozen=True)
class ChangeSetSize:
    """Size of a change set and the number of rows under its most repeated key without nulls."""

    bytes: int | None
    copies: int

    def within(self, limit: int) -> bool:
        return self.bytes is not None and self.bytes <= limit


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(quoted(c)).isNotNull() for c in columns))


def measure_change_set(changes: DataFrame, keys: Sequence[str]) -> ChangeSetSize:
    """One aggregate over the change set; keys are pre-aggregated before their shuffle."""
    width = row_bytes(changes)
    per_key = changes.groupBy(*map(quoted, keys)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.lit(0).cast("long") if width is None else width).alias("b"),
    )
    row = per_key.agg(F.sum("b").alias("b"), F.max(F.when(all_present(keys), F.col("n"))).alias("n")).first()
    return ChangeSetSize(bytes=None if width is None else row["b"] or 0, copies=row["n"] or 0)
