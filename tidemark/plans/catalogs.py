"""Catalog tables for the time of one query."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import new_path


@contextmanager
def catalog_table(rows: DataFrame, name: str, partitions: Sequence[str] = (), form: str = "parquet") -> Iterator[str]:
    """A table in a database of its own, which is gone afterwards. The files stay in the shared folder,
    so that a relation made from the table can be read; of a partitioned one, materialize it first, since its
    partitions are listed by the catalog."""
    spark: SparkSession = rows.sparkSession
    database = f"tidemark_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_path(spark, database)}'")
    try:
        writer = rows.write.format(form).option("path", new_path(spark, name))
        (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(f"{database}.{name}")
        yield f"{database}.{name}"
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
