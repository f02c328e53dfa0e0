"""Query op10: fingerprints of all documents and of their edited texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import fingerprints
from .registry import query
from .text import table


@query("op10_fingerprint_documents")
def op10_fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints.compare_with_edits(docs).withColumnRenamed("id", "doc_id")
