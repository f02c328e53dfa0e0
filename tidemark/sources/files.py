"""Readers for delimited text, JSON lines and parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads all the text one
    more time; give the schema for large inputs."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and every column a string."""
    return spark.read.load(path, format="csv", header=True)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; nested objects become structs. Inference reads the text one more time."""
    return (spark.read if schema is None else spark.read.schema(schema)).json(path)


def date_in_path(pattern: str, date_format: str) -> Column:
    """The date that the path of a row's file carries, such as ``.../03-21-2020.csv``."""
    text = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return F.try_to_date(text, date_format)
