"""Query op8: fingerprint and group of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import simhash
from .registry import query
from .text import table


@query("op8_simhash_near_duplicates")
def op8_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, radius 4."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    printed = materialize(simhash.with_fingerprint(docs), "simhash-documents")
    groups = simhash.components(printed).select("print", "component_id")
    return printed.join(groups, F.col("fingerprint") == F.col("print")).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
