"""Query op2: benchmark items in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontamination
from .registry import query
from .text import table


@query("op2_decontaminate_benchmark")
def op2_decontaminate_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item and the best window."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.matches(docs, table(spark, sf_dir, "benchmark"))
