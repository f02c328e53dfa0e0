"""Query op4: quality of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality
from .labelled import FOLDS
from .registry import query
from .text import fold, table

THRESHOLD = 0.3


@query("op4_quality_scores")
def op4_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, machine, keep=["doc_id"]).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
