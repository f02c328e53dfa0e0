"""Query op9: licence notices in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import licences
from .registry import query
from .text import table


@query("op9_scan_licences")
def op9_scan_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases, labels and score of every document; the text is read for the word frequencies of the
    corpus and again for the scan."""
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
