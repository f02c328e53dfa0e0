"""Sources: CSV, JSON, dated files, catalog tables, literal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from ..sources.catalog import current_database, literal_rows
from ..sources.files import date_in_path, read_csv, read_csv_strings, read_json, table
from .catalogs import catalog_table
from .registry import dates_as_text, query


@query(
    "csv_infer",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders""",
)
def csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a folder of CSV, read back with inferred types."""
    path = new_path(spark, "orders-csv")
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    orders = read_csv(spark, path)
    return dates_as_text(
        orders.withColumns(
            {
                "o_orderkey": F.col("o_orderkey").cast("long"),
                "o_custkey": F.col("o_custkey").cast("long"),
                "o_orderdate": F.col("o_orderdate").cast("date"),
            }
        )
    )


@query(
    "csv_strings",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""",
)
def csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV with a header only: every column is text."""
    path = new_path(spark, "customer-csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return read_csv_strings(spark, path)


@query(
    "json_nested",
    """SELECT event_type, COUNT(*) AS events,
  CAST(SUM(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total
FROM events GROUP BY event_type""",
)
def json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field inside the JSON text of each event."""
    props = F.from_json("props", "k LONG").alias("props")
    return (
        table(spark, sf_dir, "events")
        .select("event_type", props)
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("props.k").alias("k_total"))
    )


@query(
    "json_commit_log",
    """SELECT 'commitInfo' AS kind, o_orderpriority AS label, o_orderkey AS number
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'add', 'part-' || CAST(o_orderkey AS VARCHAR), o_custkey FROM orders WHERE o_orderstatus <> 'F'""",
)
def json_commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines holding one of two nested objects; each kind is selected where it is present."""
    path = new_path(spark, "log-json")
    final = F.col("o_orderstatus") == "F"
    metrics = F.struct(F.col("o_orderkey").alias("numOutputRows"))
    info = F.struct(F.col("o_orderpriority").alias("operation"), metrics.alias("operationMetrics"))
    added = F.struct(
        F.concat(F.lit("part-"), F.col("o_orderkey").cast("string")).alias("path"),
        F.col("o_custkey").alias("size"),
    )
    table(spark, sf_dir, "orders").select(
        F.when(final, info).alias("commitInfo"), F.when(~final, added).alias("add")
    ).write.json(path)

    log = read_json(spark, path)
    commits = (
        log.select("commitInfo")
        .where("commitInfo IS NOT NULL")
        .select(
            F.lit("commitInfo").alias("kind"),
            F.col("commitInfo.operation").alias("label"),
            F.col("commitInfo.operationMetrics.numOutputRows").alias("number"),
        )
    )
    files = (
        log.select("add")
        .where("add IS NOT NULL")
        .select(F.lit("add"), F.col("add.path"), F.col("add.size"))
    )
    return commits.union(files)


@query(
    "file_date",
    "SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS process_date FROM events",
)
def file_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily files whose date is only in their path. A day with very many events is written by
    several tasks (the rebalance hint splits it)."""
    path = new_path(spark, "daily")
    (
        table(spark, sf_dir, "events")
        .select("event_id", "user_id", F.date_format("ts", "MM-dd-yyyy").alias("report"))
        .hint("rebalance", F.col("report"))
        .write.partitionBy("report")
        .parquet(path)
    )
    daily = spark.read.option("recursiveFileLookup", True).parquet(path)
    return dates_as_text(
        daily.withColumn("process_date", date_in_path(r"(\d{2}-\d{2}-\d{4})", "MM-dd-yyyy"))
    )


@query("catalog_scan", "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey")
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table, found by its unqualified name in the current database."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    with catalog_table(customer, "customer_dimension") as name, current_database(spark, name.split(".")[0]):
        return spark.table("customer_dimension").orderBy("c_custkey")


_RANKS = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", None)]


@query(
    "literal_rows",
    """SELECT o.o_orderkey, r.rank
FROM orders o JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', NULL))
  AS r(o_orderpriority, rank) ON o.o_orderpriority = r.o_orderpriority""",
)
def literal_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders looked up in a relation written in the program."""
    ranks = literal_rows(spark, _RANKS, "o_orderpriority string, rank int")
    return (
        table(spark, sf_dir, "orders").join(F.broadcast(ranks), "o_orderpriority").select("o_orderkey", "rank")
    )
