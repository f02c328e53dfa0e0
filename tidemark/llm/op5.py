"""Query op5: the mix of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import materialize
from . import mixing
from .registry import query
from .text import table

#: The mix as common table expressions over ``docs`` (doc_id, text, source): ends in ``mixed``,
#: with a row for each row of ``docs`` and its number of copies.
MIX_SQL = """
sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null:' || coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM docs),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight
  FROM sized GROUP BY source),
filling AS (  -- sources in the order in which they become full
  SELECT *, row_number() OVER o AS k,
         coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
         (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS free
  FROM sources WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)),
level AS (
  SELECT ((SELECT sum(source_size) FROM sources)::BIGINT - capped)::DOUBLE / free AS words
  FROM filling WHERE 3 * source_size > ((SELECT sum(source_size) FROM sources)::BIGINT - capped)::DOUBLE / free * weight
  ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size, least(coalesce((SELECT words FROM level), 0) * weight, 3 * source_size::DOUBLE) AS target
  FROM sources),
budgets AS (
  SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS whole,
         target - floor(target / greatest(source_size, 1)) * source_size AS budget
  FROM targets),
hashes AS (
  SELECT source, h, sum(size) AS words,
         coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM sized GROUP BY source, h),
edges AS (  -- the hash value on the boundary, and whether it is still taken
  SELECT a.source, a.h + (2 * (b.budget - a.below) >= a.words)::INT AS threshold
  FROM hashes a JOIN budgets b ON a.source IS NOT DISTINCT FROM b.source
  WHERE b.budget > 0 AND a.below <= b.budget AND a.below + a.words > b.budget),
mixed AS (
  SELECT d.*, b.source_size, b.target, b.whole + coalesce(d.h < e.threshold, FALSE)::INT AS copies
  FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
  LEFT JOIN edges e ON d.source IS NOT DISTINCT FROM e.source)
"""


@query(
    "op5_mix_sources",
    f"""WITH docs AS (SELECT doc_id, text, source FROM documents), {MIX_SQL}
SELECT doc_id, source, size, source_size, target, size * copies AS taken FROM mixed""",
)
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    narrow = materialize(mixing.sized(docs), "mix-sizes")
    limits = mixing.thresholds(narrow, mixing.targets(narrow))
    limits = broadcast_if_small(limits.withColumnRenamed("source", "of"))
    return narrow.join(limits, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("ident").alias("doc_id"),
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * mixing.copies_of(F.col("hash"))).alias("taken"),
    )
