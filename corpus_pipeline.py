"""The corpus pipeline: each stage applies one operator to all documents that its predecessor kept.

``run`` writes the result of each stage to the shared folder and reads it back, so a lost executor costs a
part of one stage only. All stages but the last return the columns of ``documents`` as they are, whatever their names.
Null texts pass as empty ones, very long ones are processed whole, ties are broken by hashes of text and row, repeated rows are
near duplicates of each other, and an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, mixing, quality, sharding, simhash
from tidemark.llm.text import private, table
from tidemark.session import materialize

QUALITY = 0.3
#: Shards are split until they have at most so many bytes on average; there are always at least ``SHARDS``.
SHARD_BYTES = 1 << 30
SHARDS = 8


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``QUALITY`` or more; the machine is trained on labels of ``docs``."""
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.kept(docs, machine, QUALITY)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_matches(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three times, or not at all."""
    own = private(docs, "own_copies")  # a column of the user that has the name of the operator's
    renamed = docs.toDF(*(own if c.lower() == "copies" else c for c in docs.columns))
    columns = [F.col(f"`{c}`") for c in renamed.columns]
    mixed = mixing.mix(renamed).filter("copies > 0")
    return mixed.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*columns).toDF(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their place in it."""
    return sharding.shard(docs, target_bytes=SHARD_BYTES, least=SHARDS)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: SQL has neither the classifier nor the fingerprints; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
