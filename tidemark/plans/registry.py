"""Name -> query and SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates in ISO text, so that both engines hand out the same values."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
    )
