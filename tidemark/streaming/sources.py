"""Unbounded inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..session import new_path
from ..sources.files import table


def rate(spark: SparkSession, rows_per_second: int = 5, partitions: int = 1) -> DataFrame:
    """Generated ``(timestamp, value)`` rows at a fixed rate."""
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", partitions)
        .load()
    )


def replayed(rows: DataFrame, batch: Column, batches: int, files: int = 1) -> DataFrame:
    """A stored table as a stream that brings the rows of ``batch`` 0, 1 and so on, ``files`` files each, in one micro-batch
    after the other: an order of arrival that file listings alone do not keep."""
    spark = rows.sparkSession
    path = new_path(spark, "replayed")
    for i in range(batches):
        rows.where(batch == i).repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def parquet_table(
    spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """One of the provided tables as a stream of its files, whether it is one file or a folder."""
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")  # a pattern may also match a single file
