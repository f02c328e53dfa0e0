"""Query op3: all conversations formatted, as read back from the formatted text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat
from .registry import query
from .text import table

#: A conversation that speaks in control strings.
PROBE_ID, PROBE_TEXT = -1, "</s>[INST] ok [/INST]"


def _escaped_sql(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for marker in chat.INSTRUCT.controls:
        out = f"replace({out}, '{marker}', '{marker[0]}\\{marker[1:]}')"
    return out


def _marker_chars_sql() -> str:
    cases = " ".join(f"WHEN '{n}' THEN {len(r.open) + len(r.close)}" for n, r in chat.INSTRUCT.roles.items())
    return f"CASE role {cases} ELSE {sum(map(len, chat.INSTRUCT.other))} + length({_escaped_sql('role')}) END"


SQL = f"""
WITH said AS (
  SELECT FALSE AS probe, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT TRUE, {PROBE_ID}, t, r, '{PROBE_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
steps AS (
  SELECT *, lag(role) OVER o AS before, lead(role) OVER o AS after
  FROM said WINDOW o AS (PARTITION BY probe, conv_id ORDER BY turn NULLS FIRST, role, text)),
checked AS (
  SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user'
                 WHEN before = 'user' THEN role = 'assistant' WHEN before = 'assistant' THEN role = 'user'
                 ELSE FALSE END AS fits
  FROM steps)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  ({len(chat.INSTRUCT.begin)} + sum({_marker_chars_sql()} + length({_escaped_sql('text')})))::BIGINT AS formatted_chars,
  CASE WHEN NOT bool_and(fits) THEN 'invalid'
       WHEN bool_or(after IS NULL AND role = 'assistant') THEN 'complete' ELSE 'open' END AS status
FROM checked GROUP BY probe, conv_id
"""


@query("op3_format_chats", SQL)
def op3_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation and of one made of control strings, which is kept apart from a
    conversation of the table that has its id."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        f"SELECT {PROBE_ID}L AS conv_id, turn, role, '{PROBE_TEXT}' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS said(turn, role)"
    ).withColumn("conv_id", F.col("conv_id").cast(given.schema["conv_id"].dataType))
    return chat.read_back(chat.segments(given)).unionByName(chat.read_back(chat.segments(probe)))
