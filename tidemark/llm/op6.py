"""Query op6: all documents in eight shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import sharding
from .registry import query
from .text import table

SHARDS = 8


@query("op6_shard_documents")
def op6_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; the law is that of near equal bytes, so nothing is said of
    one more shard."""
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    columns = sharding.place_columns(docs, "doc_id", "text")
    narrow = materialize(docs.select("doc_id", crc, *columns), "shard-places")
    levels = sharding.grow(narrow.select("size", "group", "tie", "axes"), SHARDS)
    placed = sharding.place(narrow, levels).withColumn("shard", F.col("node").cast("int"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("group"), F.col("tie")]
    numbered = sharding.with_slot(placed, "shard", order, F.col("tie"), narrow.count(), SHARDS)
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
