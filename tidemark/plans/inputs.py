"""Relations that several queries derive from the provided tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import table

# --- a customer dimension and the updates for it --------------------------------------------

TRACKED = ["c_nationkey", "c_mktsegment"]

#: Small enough for the provided tables to be numbered in several ranges.
ROWS_PER_RANGE = 500

DIMENSION_SQL = """
dim AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
         DATE '1995-01-01' AS effective_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_current
  FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, 'UNASSIGNED', DATE '1990-01-01', DATE '1995-01-01', FALSE
  FROM customer WHERE c_acctbal >= 5000
)"""

UPDATES_SQL = """
upd AS (
  SELECT CASE WHEN c_acctbal >= 9000 THEN -1 - c_custkey ELSE c_custkey END AS c_custkey,
         c_name, c_nationkey,
         CASE WHEN c_acctbal < 0 THEN 'COLLECTIONS' WHEN c_acctbal >= 500 THEN c_mktsegment
         END AS c_mktsegment,
         DATE '2000-01-01' AS effective_date
  FROM customer WHERE c_acctbal < 1000 OR c_acctbal >= 9000
)"""


def date(text: str):
    return F.lit(text).cast("date")


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a current version; those with 5,000 or more also as a closed older one."""
    customer = table(spark, sf_dir, "customer")
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    current = customer.select(
        *columns,
        date("1995-01-01").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
    )
    older = customer.where("c_acctbal >= 5000").select(
        *columns[:3],
        F.lit("UNASSIGNED").alias("c_mktsegment"),
        date("1990-01-01").alias("effective_date"),
        date("1995-01-01").alias("end_date"),
        F.lit(False).alias("is_current"),
    )
    return current.unionByName(older)


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debtors change segment, low balances lose it, the next ones are unchanged, and high
    balances come under a new key."""
    balance = F.col("c_acctbal")
    return (
        table(spark, sf_dir, "customer")
        .where((balance < 1000) | (balance >= 9000))
        .select(
            F.when(balance >= 9000, -1 - F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("c_custkey"),
            "c_name",
            "c_nationkey",
            F.when(balance < 0, "COLLECTIONS")
            .when(balance >= 500, F.col("c_mktsegment"))
            .alias("c_mktsegment"),
            date("2000-01-01").alias("effective_date"),
        )
    )


# --- change rows that say themselves whether they end or open a version ---------------------

MODIFICATIONS_SQL = """
mods AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, DATE '1995-01-01' AS effective_date,
         CASE WHEN c_acctbal < 0 THEN DATE '2000-01-01' ELSE DATE '1994-01-01' END AS end_date,
         FALSE AS is_current
  FROM customer WHERE c_acctbal < 500
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, 'COLLECTIONS', DATE '2000-01-01', NULL, TRUE
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, 'COLLECTIONS', DATE '2000-01-01', NULL, TRUE
  FROM customer WHERE c_acctbal < -500
  UNION ALL
  SELECT -1 - c_custkey, c_name, c_nationkey, c_mktsegment, DATE '2000-01-01', NULL, TRUE
  FROM customer WHERE c_acctbal >= 9000
  UNION ALL
  SELECT -1 - c_custkey, c_name, c_nationkey, c_mktsegment, DATE '1995-01-01', DATE '2000-01-01', FALSE
  FROM customer WHERE c_acctbal >= 9500
)"""


def modifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing rows (some ending before they start, some for unknown keys) and opening rows, some
    of them twice."""
    customer = table(spark, sf_dir, "customer")
    closed_at = F.when(F.col("c_acctbal") < 0, date("2000-01-01")).otherwise(date("1994-01-01"))

    def rows(condition, key, segment, start, end, current):
        return customer.where(condition).select(
            F.expr(key).alias("c_custkey"),
            "c_name",
            "c_nationkey",
            segment.alias("c_mktsegment"),
            date(start).alias("effective_date"),
            end.cast("date").alias("end_date"),
            F.lit(current).alias("is_current"),
        )

    segment, moved, open_end = F.col("c_mktsegment"), F.lit("COLLECTIONS"), F.lit(None)
    return (
        rows("c_acctbal < 500", "c_custkey", segment, "1995-01-01", closed_at, False)
        .union(rows("c_acctbal < 0", "c_custkey", moved, "2000-01-01", open_end, True))
        .union(rows("c_acctbal < -500", "c_custkey", moved, "2000-01-01", open_end, True))
        .union(rows("c_acctbal >= 9000", "-1 - c_custkey", segment, "2000-01-01", open_end, True))
        .union(rows("c_acctbal >= 9500", "-1 - c_custkey", segment, "1995-01-01", date("2000-01-01"), False))
    )


# --- the dimension under a surrogate id -----------------------------------------------------

SURROGATE_SQL = """
sdim AS (
  SELECT c_custkey AS id, c_custkey, c_name, c_mktsegment,
         DATE '1995-01-01' AS start_date, CAST(NULL AS DATE) AS end_date
  FROM customer
  UNION ALL
  SELECT -1 - c_custkey, c_custkey, c_name, 'UNASSIGNED', DATE '1990-01-01', DATE '1995-01-01'
  FROM customer WHERE c_acctbal >= 5000
), incoming AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_acctbal < 0 THEN 'COLLECTIONS' ELSE 'PREMIUM' END AS c_mktsegment
  FROM customer WHERE c_acctbal < 0 OR c_acctbal >= 9000
), merged AS (
  SELECT id, c_custkey, c_name, c_mktsegment, start_date,
         CASE WHEN end_date IS NULL AND c_custkey IN (SELECT c_custkey FROM incoming)
              THEN DATE '2000-01-01' ELSE end_date END AS end_date
  FROM sdim
  UNION ALL
  SELECT NULL, c_custkey, c_name, c_mktsegment, DATE '2000-01-01', NULL FROM incoming
)"""


def surrogate_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    current = customer.select(
        F.col("c_custkey").alias("id"),
        "c_custkey",
        "c_name",
        "c_mktsegment",
        date("1995-01-01").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
    )
    older = customer.where("c_acctbal >= 5000").select(
        (-1 - F.col("c_custkey")).alias("id"),
        "c_custkey",
        "c_name",
        F.lit("UNASSIGNED").alias("c_mktsegment"),
        date("1990-01-01").alias("start_date"),
        date("1995-01-01").alias("end_date"),
    )
    return current.unionByName(older)


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where("c_acctbal < 0 OR c_acctbal >= 9000")
        .select(
            "c_custkey",
            "c_name",
            F.when(F.col("c_acctbal") < 0, "COLLECTIONS").otherwise("PREMIUM").alias("c_mktsegment"),
        )
    )
