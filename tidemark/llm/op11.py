"""Query op11: component of every document by three-word shingles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import minhash
from .registry import query
from .text import table

WORDS_PER_SHINGLE, PERCENT = 3, 85

SQL = f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < {WORDS_PER_SHINGLE} THEN [array_to_string(words, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(words) - {WORDS_PER_SHINGLE - 2}), lambda i: array_to_string(words[i:i + {WORDS_PER_SHINGLE - 1}], ' ')))) END AS shingles
  FROM w),
classes AS (SELECT min(r) AS c, shingles FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
each AS (SELECT c, len(shingles) AS n, unnest(shingles) AS shingle FROM classes),
links AS (
  SELECT a.c AS a, b.c AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.c < b.c
    AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (SELECT c, c FROM classes UNION SELECT reached.a, ways.b FROM reached JOIN ways ON reached.b = ways.a),
roots AS (SELECT a AS c, min(b) AS root FROM reached GROUP BY a),
rooted AS (SELECT r, root FROM sets JOIN classes USING (shingles) JOIN roots USING (c)),
least_id AS (SELECT root, min(doc_id) AS component_id FROM rooted JOIN sets USING (r) GROUP BY root)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, CASE WHEN root IS NULL THEN doc_id ELSE component_id END AS component_id,
  doc_id IS NOT DISTINCT FROM CASE WHEN root IS NULL THEN doc_id ELSE component_id END AS kept
FROM sets LEFT JOIN rooted USING (r) LEFT JOIN least_id USING (root)
"""


@query("op11_minhash_near_duplicates", SQL)
def op11_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; links of at least 85 of 100."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=WORDS_PER_SHINGLE, percent=PERCENT)
