"""Conditional update and delete."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import as_expr, must_find, quoted


def update_where(df: DataFrame, set: Mapping[str, object], condition: str | Column | None = None) -> DataFrame:
    """Assign columns in the rows for which ``condition`` is true. Every value sees the old row
    and is cast to the type of its column."""
    applies = F.lit(True) if condition is None else as_expr(condition)
    values = {must_find(df.columns, name): as_expr(value) for name, value in set.items()}
    return df.select(
        *(
            F.when(applies, values[f.name].cast(f.dataType)).otherwise(F.col(quoted(f.name))).alias(f.name)
            if f.name in values
            else F.col(quoted(f.name))
            for f in df.schema.fields
        )
    )


def delete_where(df: DataFrame, condition: str | Column) -> DataFrame:
    """Remove the rows for which ``condition`` is true; rows where it is unknown stay. Written so
    that the remaining predicate still reaches the scan."""
    gone = as_expr(condition)
    return df.where(~gone | gone.isNull())


def delete_all(df: DataFrame) -> DataFrame:
    """No rows, same schema; nothing is read."""
    return df.where(F.lit(False))
