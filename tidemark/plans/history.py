"""Point-in-time reads of an order table kept as a change log."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import union_evolving
from ..operators.merge import WhenMatched, WhenNotMatched, merge
from ..operators.versions import append_commit, as_of, commit, commit_merge, history, state_at, write_snapshot
from ..session import materialize, new_path
from ..sources.files import table
from .registry import query

_COMMITS = [datetime(2024, month, 1) for month in (1, 2, 3, 4)]

_LOG_SQL = """
WITH log AS (
  SELECT o_orderkey, o_custkey, o_totalprice, 0 AS v, TIMESTAMP '2024-01-01' AS ts, 'insert' AS op FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice + 1, 1, TIMESTAMP '2024-02-01', 'update'
  FROM orders WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice, 2, TIMESTAMP '2024-03-01', 'delete'
  FROM orders WHERE o_orderpriority = '5-LOW'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice + 5, 3, TIMESTAMP '2024-04-01', 'insert'
  FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
)"""


def _as_of_sql(condition: str) -> str:
    return f"""{_LOG_SQL}
SELECT o_orderkey, o_custkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY v DESC) AS newest
  FROM log WHERE {condition}
) AS seen WHERE newest = 1 AND op <> 'delete'"""


def _change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders inserted, open ones re-priced, low-priority ones deleted, some of them back."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]

    def priced(rows: DataFrame, extra: int) -> DataFrame:
        return rows.withColumn("o_totalprice", F.col("o_totalprice") + extra)

    low = orders.where("o_orderpriority = '5-LOW'")
    return union_evolving(
        commit(orders.select(columns), 0, _COMMITS[0], "insert"),
        commit(priced(orders.where("o_orderstatus = 'O'"), 1).select(columns), 1, _COMMITS[1], "update"),
        commit(low.select(columns), 2, _COMMITS[2], "delete"),
        commit(priced(low.where("o_orderstatus = 'F'"), 5).select(columns), 3, _COMMITS[3], "insert"),
    )


@query("snapshot_latest", _as_of_sql("TRUE"))
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of(_change_log(spark, sf_dir), ["o_orderkey"])


@query("as_of_version", _as_of_sql("v <= 1"))
def as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of(_change_log(spark, sf_dir), ["o_orderkey"], version=1)


@query("as_of_timestamp", _as_of_sql("ts <= TIMESTAMP '2024-03-15'"))
def as_of_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between two commits the earlier one counts."""
    return as_of(_change_log(spark, sf_dir), ["o_orderkey"], timestamp=datetime(2024, 3, 15))


@query(
    "change_history",
    f"""{_LOG_SQL}
SELECT v AS version, ts AS committed,
  COUNT(CASE WHEN op = 'insert' THEN 1 END) AS rows_inserted,
  COUNT(CASE WHEN op = 'update' THEN 1 END) AS rows_updated,
  COUNT(CASE WHEN op = 'delete' THEN 1 END) AS rows_deleted
FROM log GROUP BY v, ts""",
)
def change_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(_change_log(spark, sf_dir))


def _stored_log(spark: SparkSession, sf_dir: str) -> str:
    """The commits of the change log in folders of their own, with a snapshot after the third."""
    root, log = new_path(spark, "order-log"), materialize(_change_log(spark, sf_dir), "log")
    for version, committed in enumerate(_COMMITS):
        append_commit(log.where(F.col("_version") == version), root, version, committed)
        if version == 2:
            write_snapshot(spark, root, ["o_orderkey"], version)
    return root


@query("as_of_snapshot", _as_of_sql("TRUE"))
def as_of_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last version, from the snapshot before it and one commit."""
    return state_at(spark, _stored_log(spark, sf_dir), ["o_orderkey"])


@query("as_of_snapshot_timestamp", _as_of_sql("ts <= TIMESTAMP '2024-03-15'"))
def as_of_snapshot_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A moment with a zone, in which it is still the day before; the snapshot alone answers."""
    moment = datetime(2024, 3, 14, 22, tzinfo=timezone(timedelta(hours=-2)))
    return state_at(spark, _stored_log(spark, sf_dir), ["o_orderkey"], timestamp=moment)


_MERGE_LOG_SQL = """
WITH changes AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey,
         o_custkey, o_totalprice + 7 AS o_totalprice
  FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '2-HIGH'
)"""


def _merge_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders inserted, then a merge of new and re-priced ones, as its two commits."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    part = F.col("o_orderstatus") == "P"
    changes = orders.where(part | (F.col("o_orderpriority") == "2-HIGH")).select(
        F.when(part, -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        "o_custkey",
        (F.col("o_totalprice") + 7).alias("o_totalprice"),
    )
    stored = orders.select(columns)
    merged = merge(stored, changes, "o_orderkey", [WhenMatched()], [WhenNotMatched()], with_action=True)
    first = commit(stored, 0, _COMMITS[0], "insert")
    return first.unionByName(commit_merge(materialize(merged, "merged"), 1, _COMMITS[1]))


@query(
    "merge_history",
    f"""{_MERGE_LOG_SQL}
SELECT 0 AS version, TIMESTAMP '2024-01-01' AS committed, COUNT(*) AS rows_inserted,
       CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted FROM orders
UNION ALL
SELECT 1, TIMESTAMP '2024-02-01', COUNT(CASE WHEN o_orderkey < 0 THEN 1 END),
       COUNT(CASE WHEN o_orderkey >= 0 THEN 1 END), 0 FROM changes""",
)
def merge_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merge did, read from the change log that it was committed to."""
    return history(_merge_log(spark, sf_dir))


@query(
    "merge_as_of",
    f"""{_MERGE_LOG_SQL}
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes)
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM changes""",
)
def merge_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after the merge, read from the same log."""
    return as_of(_merge_log(spark, sf_dir), ["o_orderkey"], version=1)
