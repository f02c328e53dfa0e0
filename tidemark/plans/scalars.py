"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..sources.files import table
from .registry import dates_as_text, query


@query(
    "case_when",
    """SELECT p_partkey, CASE WHEN p_type = 'PROMO' AND p_size < 5 THEN 'small promo' ELSE p_brand END AS p_brand,
  CASE WHEN p_size > 30 THEN 'big' WHEN p_size > 10 THEN 'middle' END AS class
FROM part""",
)
def case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value replaced in some rows, and a chain without default."""
    small_promo = (F.col("p_type") == "PROMO") & (F.col("p_size") < 5)
    brand = F.when(small_promo, "small promo").otherwise(F.col("p_brand"))
    size_class = F.when(F.col("p_size") > 30, "big").when(F.col("p_size") > 10, "middle")
    return table(spark, sf_dir, "part").select(
        "p_partkey", brand.alias("p_brand"), size_class.alias("class")
    )


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
  CAST(month(o_orderdate) AS INTEGER) AS order_month
FROM orders""",
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year of a date and month of its ISO text; names resolve whatever their case."""
    iso = F.date_format("O_ORDERDATE", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderDate").alias("order_year"), F.month(iso).alias("order_month")
    )


@query(
    "parse_date",
    """SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date
FROM orders""",
)
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates such as 2/24/2003 0:00; text of another format gives null."""
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "M/d/yyyy H:mm")
    )
    return dates_as_text(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", scalars.parse_date(text, "M/d/yyyy H:mm").alias("order_date")
        )
    )


@query(
    "parse_epoch",
    """SELECT event_id, CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS seconds,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS day
FROM events""",
)
def parse_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to seconds since 1970, and those to a date."""
    text = F.date_format("ts", "M/d/yyyy H:mm")
    seconds = scalars.parse_epoch(text, "M/d/yyyy H:mm")
    events = table(spark, sf_dir, "events").select("event_id", seconds.alias("seconds"))
    return dates_as_text(events.withColumn("day", scalars.epoch_date(F.col("seconds"))))


@query(
    "arithmetic",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * 0.9 AS reduced,
  l_orderkey - 50 AS earlier_key, CAST(l_linenumber - 1 AS INTEGER) AS line_index
FROM lineitem""",
)
def arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice * 0.9 AS reduced",
        "l_orderkey - 50 AS earlier_key",
        "l_linenumber - 1 AS line_index",
    )


@query(
    "regexp_clean",
    "SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9]', '_', 'g') AS url_name FROM pages",
)
def regexp_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", scalars.clean_name(F.col("url")).alias("url_name"))


@query("full_name", "SELECT p_partkey, p_brand || ' ' || p_name AS full_name FROM part")
def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", scalars.full_name(F.col("p_brand"), F.col("p_name")).alias("full_name")
    )
