"""Catalog tables and literal rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def current_database(spark: SparkSession, name: str) -> Iterator[None]:
    """Resolve unqualified table names in ``name`` within the block."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(name)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def literal_rows(spark: SparkSession, rows: Sequence, schema) -> DataFrame:
    """A small relation written in the program: tuples with names, dicts, or a full schema."""
    return spark.createDataFrame(list(rows), schema)
