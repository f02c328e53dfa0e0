"""Running a stream over what has arrived."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.writes import setting
from ..session import new_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Run:
    """The table that a stream has written, and what its micro-batches report: how many had rows, how many rows
    (of a stateful operator's input) came after the watermark and were dropped, and the most rows held in state."""

    table: DataFrame
    batches: int
    dropped: int
    most_state: int


def run_batches(stream: DataFrame, label: str, rocksdb: bool = True) -> Run:
    """Process all available input into parquet, state and offsets under the shared folder. State is kept in RocksDB, outside the
    heap, unless told otherwise; how much a micro-batch takes is set at the source."""
    spark = stream.sparkSession
    path = new_path(spark, label)
    name = "spark.sql.streaming.stateStore.providerClass"
    with setting(spark, name, ROCKSDB if rocksdb else spark.conf.get(name)):
        running = (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", new_path(spark, f"{label}-state"))
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
    reports = running.recentProgress
    held = [o for p in reports for o in p["stateOperators"]]
    return Run(
        spark.read.schema(stream.schema).parquet(path),
        sum(p["numInputRows"] > 0 for p in reports),
        sum(o["numRowsDroppedByWatermark"] for o in held),
        max((o["numRowsTotal"] for o in held), default=0),
    )


def run_available(stream: DataFrame, label: str) -> DataFrame:
    """The table that a stream writes from all available input."""
    return run_batches(stream, label, rocksdb=False).table
