"""Grouped and global aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_date
from ..sources.files import table
from .registry import query


def _money(total: Column) -> Column:
    """Sums of money are exact decimals; the order of addition cannot change them."""
    return total.cast("double")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


@query("group_count", "SELECT l_returnflag, COUNT(*) AS lines FROM lineitem GROUP BY l_returnflag")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "sql_group_count",
    """SELECT o_orderpriority AS priority, COUNT(o_custkey) AS orders FROM orders
GROUP BY o_orderpriority ORDER BY priority""",
)
def sql_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a relation that is passed in, so that no view name is taken."""
    return spark.sql(
        "SELECT o_orderpriority AS priority, COUNT(o_custkey) AS orders FROM {orders} "
        "GROUP BY o_orderpriority ORDER BY priority",
        orders=table(spark, sf_dir, "orders"),
    )


_MONTHLY_SQL = """SELECT CAST(year(o_orderdate) AS INTEGER) AS {year}, CAST(month(o_orderdate) AS INTEGER) AS {month},
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS {total}
FROM orders GROUP BY 1, 2"""


@query("monthly_sum", _MONTHLY_SQL.format(year="order_year", month="order_month", total="total_sales"))
def monthly_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .withColumn("order_year", F.year("o_orderdate"))
        .withColumn("order_month", F.month("o_orderdate"))
        .groupBy("order_year", "order_month")
        .agg(_money(F.sum(_exact("o_totalprice"))).alias("total_sales"))
    )


@query("monthly_sum_renamed", _MONTHLY_SQL.format(year="year_id", month="month", total="total_sales"))
def monthly_sum_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day is text and parsed; the sum comes under its generated name."""
    written = F.date_format("o_orderdate", "M/d/yyyy H:mm")
    day = parse_date(written, "M/d/yyyy H:mm")
    summed = (
        table(spark, sf_dir, "orders")
        .select(F.year(day).alias("year_id"), F.month(day).alias("month"), _exact("o_totalprice").alias("price"))
        .groupBy("year_id", "month")
        .agg({"price": "sum"})
    )
    return summed.select("year_id", "month", _money(F.col("sum(price)")).alias("total_sales"))


@query(
    "global_agg",
    """SELECT COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order
FROM orders""",
)
def global_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy()
        .agg(
            F.count(F.lit(1)).alias("orders"),
            _money(F.sum(_exact("o_totalprice"))).alias("total"),
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
        )
    )


@query("count_rows", "SELECT COUNT(*) AS n FROM lineitem")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "collect_list_agg",
    """SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderstatus) AS states, COUNT(*) AS n
FROM orders GROUP BY o_custkey""",
)
def collect_list_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values of a column as one list per key, copies included."""
    states = F.sort_array(F.collect_list("o_orderstatus"))
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.array_join(states, ",").alias("states"), F.count("o_orderstatus").alias("n"))
    )
