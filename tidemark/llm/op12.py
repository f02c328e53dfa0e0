"""Query op12: how sources of a language differ from each other and from the language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import divergence
from .registry import query
from .text import table

_P = "(1 + ({scale}::HUGEINT * ({count} + 5)) // ({total} + 5 * v))"


def _p(count: str, total: str) -> str:
    return _P.format(scale=divergence.SCALE, count=count, total=total)


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
occ AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS whole FROM occ GROUP BY lang, term
         HAVING count(DISTINCT id) >= {divergence.MIN_DOCUMENTS}),
cells AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(whole)::HUGEINT AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN cells USING (lang, source) GROUP BY ALL),
grid AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, {_p("coalesce(c.n, 0)", "t.total")} AS p, {_p("k.whole", "lang_total")} AS q
         FROM totals t JOIN kept k ON t.lang = k.lang JOIN langs l ON t.lang = l.lang
         LEFT JOIN cells c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM grid WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""


@query("op12_audit_source_divergence", SQL)
def op12_audit_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of sources of a language, and the terms by which a source stands out most."""
    return divergence.divergences(table(spark, sf_dir, "documents"))
