"""Writing tables: create, overwrite, append, replacing a catalog table.

A table's schema is written beside its files, in the hidden folder ``_schema``: one line of JSON for each
time that it gained columns, fields or width. So neither an append nor a read opens the footers of all files, and
columns that must not be null stay so, which parquet itself forgets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, new_path
from .names import find, quoted
from .schema import SchemaMismatch, conform, enforce, merged_schema


def create(df: DataFrame, path: str) -> None:
    """Write a new table; fails if the path holds anything."""
    df.write.mode("errorifexists").parquet(path)
    _remember(df.sparkSession, df.schema, path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a table. ``df`` must not read from ``path``; to rewrite a table from itself, write
    its next version (see :func:`tidemark.operators.versions.write_version`). Between the rows and their schema
    the table reads by the schema of its files."""
    df.write.mode("overwrite").parquet(path)
    _remember(df.sparkSession, df.schema, path)


def append(df: DataFrame, path: str) -> None:
    """Add rows that have exactly the table's columns and types, without nulls where the table has
    none; others are rejected unwritten. The table may be a parquet folder that something else wrote."""
    enforce(df, schema_of(df.sparkSession, path)).write.mode("append").parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Add rows whose new columns, and new fields of nested columns, become the table's; of two numeric types
    the wider one is kept. The table has its columns first and the new ones after them.

    The new schema is remembered before the rows are written: if that fails, the table has the new columns
    without values, and no row is lost or hidden.
    """
    old = schema_of(df.sparkSession, path)
    merged = merged_schema(old, df.schema)
    absent = [f.name for f in old.fields if not f.nullable and find(df.columns, f.name) is None]
    if absent:
        raise SchemaMismatch(f"nulls in required columns: {absent}")
    rows = conform(df, merged)
    if merged != old:
        _remember(df.sparkSession, merged, path)
    rows.write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table with the columns of all its appends."""
    return spark.read.schema(schema_of(spark, path)).parquet(path)


def schema_of(spark: SparkSession, path: str) -> T.StructType:
    """The schema of a table, the widest that was remembered. A folder without one, which something else wrote, has that of
    all its files, whose footers are opened for it once: it is remembered from then on."""
    try:
        lines = [T.StructType.fromJson(json.loads(r[0])) for r in spark.read.text(f"{path}/_schema").collect()]  # one per evolution
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = []
    if not lines:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
        _remember(spark, found, path)
        return found
    widest = max(lines, key=_leaves)
    return reduce(merged_schema, lines, widest)


def _leaves(kind: T.DataType) -> int:
    if isinstance(kind, T.StructType):
        return 1 + sum(_leaves(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return 1 + _leaves(kind.elementType)
    return 1 + _leaves(kind.valueType) if isinstance(kind, T.MapType) else 1


def _remember(spark: SparkSession, schema: T.StructType, path: str) -> None:
    line = spark.range(1).select(F.lit(schema.json()).alias("value"))
    line.coalesce(1).write.mode("append").text(f"{path}/_schema")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def catalog_name(table: str) -> str:
    return ".".join(map(quoted, table.split(".")))


def replace_table(df: DataFrame, table: str) -> None:
    """Replace a catalog table by position, also from a query over that same table, in the table's own format.

    A table without partitions gets a new location: the rows are written once, beside the old ones, and the
    table is then pointed at them. A failed write leaves it as it was; the old files stay until they are expired.

    A partitioned table is replaced partition by partition, by dynamic overwrite from a staged copy, and
    partitions without new rows are dropped. Nothing changes before the copy is complete; if the write itself
    fails, old partitions are still there or the same call may be repeated from the copy.
    """
    spark = df.sparkSession
    wanted = spark.table(table).schema
    if len(wanted) != len(df.columns):
        raise ValueError(f"{table} has {len(wanted)} columns, the rows have {len(df.columns)}")
    renamed = df.toDF(*(f"c{i}" for i in range(len(wanted))))
    typed = renamed.select(*(F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(wanted.fields)))
    partitions = partition_columns(spark, table)
    if partitions:
        before = spark.table(table).select(*map(quoted, partitions)).distinct().collect()  # a row per partition
        replace_partitions(materialize(typed, "staged"), table, before)
        return
    path, name = new_path(spark, "replaced"), catalog_name(table)
    beside = f"{table.rpartition('.')[0]}.replaced_{uuid.uuid4().hex}".lstrip(".")
    spark.sql(f"CREATE TABLE {catalog_name(beside)} LIKE {name} LOCATION '{path}'")  # of the same format and options
    try:
        typed.write.insertInto(catalog_name(beside))
    finally:
        spark.sql(f"DROP TABLE {catalog_name(beside)}")  # its files stay, since it has a location of its own
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def replace_partitions(rows: DataFrame, table: str, before: Sequence[Row] = ()) -> None:
    """Replace those partitions of a catalog table that occur in ``rows`` (stored, in the order of the table's columns), and drop those
    of ``before`` that do not. Other partitions keep their files. Skewed partitions are written by several tasks."""
    spark = rows.sparkSession
    partitions = partition_columns(spark, table)
    after = {tuple(r) for r in rows.select(*map(quoted, partitions)).distinct().collect()}  # a row per partition
    spread = rows.hint("rebalance", *(F.col(quoted(c)) for c in partitions))
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):  # an option of the writer does not reach insertInto
        spread.write.mode("overwrite").insertInto(catalog_name(table))
    for gone in {tuple(r) for r in before} - after:
        given = ", ".join(f"{quoted(c)} = {_sql_literal(v)}" for c, v in zip(partitions, gone))
        spark.sql(f"ALTER TABLE {catalog_name(table)} DROP IF EXISTS PARTITION ({given})")
    spark.catalog.refreshTable(table)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time of a write."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def in_partitions(table: DataFrame, columns: Sequence[str], values: Sequence[Row]) -> DataFrame:
    """Rows of the given partitions: a filter on partition columns, so that other files are not read."""
    if not values:
        return table.where(F.lit(False))
    if len(columns) == 1:
        column, known = F.col(quoted(columns[0])), [v[0] for v in values if v[0] is not None]
        chosen = column.isin(known) if known else F.lit(False)
        return table.where(chosen | column.isNull() if len(known) < len(values) else chosen)
    one = lambda v: reduce(and_, (F.col(quoted(c)).eqNullSafe(F.lit(x)) for c, x in zip(columns, v)))
    return table.where(reduce(or_, map(one, values)))
