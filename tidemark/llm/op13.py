"""Query op13: damaged conversations, their faults and their cheapest repair."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair as repairs
from .registry import query
from .text import table

KINDS = 20  # remainders; the first five damage a row
DROPPED, EMPTIED, UNSTOPPED, REPEATED, RENAMED = range(5)
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the damage that the crc32 of ``conv_id:turn`` says; nulls are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % KINDS
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    return rows.filter(F.col("kind") != DROPPED).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == RENAMED, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == EMPTIED, "")
        .when(F.col("kind") == UNSTOPPED, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == REPEATED, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


@query("op13_repair_conversations")
def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each conversation of the table, also for those that the damage leaves without rows."""
    given = table(spark, sf_dir, "conversations")
    found = repairs.repair(damaged(given))
    whole = found.conversations.drop("conv_id").join(repairs.digests(found.edits), "conv")
    ids = given.select("conv_id").distinct().withColumn("conv", repairs._print(F.col("conv_id").cast("string")))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(whole, "conv", "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"),
    )
