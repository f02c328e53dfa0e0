"""Query op7: language model scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pitman_yor
from .registry import query
from .text import fold, table


@query("op7_pitman_yor_scores")
def op7_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = (fold(F.col("doc_id"), pitman_yor.FOLDS) == pitman_yor.HELD_OUT).alias("held_out")
    return pitman_yor.score(docs).select(
        "doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
