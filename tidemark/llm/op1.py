"""Query op1: toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import toxicity
from .labelled import FOLDS
from .registry import query
from .text import fold, table

THRESHOLD = 0.5


@query("op1_toxicity_scores")
def op1_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, network, keep=["doc_id"]).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
