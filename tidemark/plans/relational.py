"""Projections, filters, joins, unions, order."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import try_integer
from ..operators.joins import anti_join, interval_join, semi_join
from ..operators.numbering import with_row_number
from ..operators.rows import sample_by_key
from ..operators.schema import conform
from ..sources.files import table
from .inputs import ROWS_PER_RANGE, UPDATES_SQL, updates
from .registry import dates_as_text, query

# --- projections ----------------------------------------------------------------------------


@query("project_columns", "SELECT s_suppkey, s_acctbal FROM supplier")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(["s_suppkey", "s_acctbal"])


@query(
    "select_expr",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, upper(l_returnflag) AS flag
FROM lineitem""",
)
def select_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    net, flag = "l_extendedprice * (1 - l_discount) AS net", "upper(l_returnflag) AS flag"
    return table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", net, flag)


@query(
    "with_column",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
  CAST(year(o_orderdate) AS INTEGER) AS order_year
FROM orders""",
)
def with_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column replaced, one added."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return dates_as_text(
        orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date")).withColumn(
            "order_year", F.year("o_orderdate")
        )
    )


@query(
    "rename_columns",
    """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal AS balance
FROM supplier""",
)
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_acctbal": "balance"}
    )


@query(
    "literal_columns",
    """SELECT s_suppkey, '2020-04-11' AS process_date, CAST(3 AS INTEGER) AS level, TRUE AS is_current,
  CAST(NULL AS BIGINT) AS merge_key
FROM supplier""",
)
def literal_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey")
        .withColumns(
            {
                "process_date": F.lit("2020-04-11"),
                "level": F.lit(3),
                "is_current": F.lit(True),
                "merge_key": F.lit(None).cast("long"),
            }
        )
    )


@query(
    "cast_columns",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
  CAST(trunc(o_totalprice) AS INTEGER) AS whole_price,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
  TRY_CAST(o_orderstatus AS INTEGER) AS not_a_number
FROM orders""",
)
def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts to date and integer; text that is no number becomes null."""
    return dates_as_text(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_totalprice").cast("int").alias("whole_price"),
            try_integer(F.substring("o_orderpriority", 1, 1)).alias("priority"),
            try_integer(F.col("o_orderstatus")).alias("not_a_number"),
        )
    )


# --- filters --------------------------------------------------------------------------------


@query("filter_eq", "SELECT p_partkey, p_name FROM part WHERE p_type = 'PROMO' AND p_brand = 'Brand#12'")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality as SQL text and as a column."""
    part = table(spark, sf_dir, "part")
    return part.where("p_type == 'PROMO'").where(F.col("p_brand") == "Brand#12").select("p_partkey", "p_name")


@query(
    "filter_or",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice > 300000",
)
def filter_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent, large = F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 300000
    return table(spark, sf_dir, "orders").where(urgent | large).select("o_orderkey", "o_orderdate")


_CHECKED_SQL = "SELECT * FROM {table} WHERE c_mktsegment = 'BUILDING' OR c_nationkey = 6"


@query("sql_filter_or", _CHECKED_SQL.format(table="customer"))
def sql_filter_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kind of filter as SQL text over a relation that is passed in."""
    return spark.sql(_CHECKED_SQL, table=table(spark, sf_dir, "customer"))


@query(
    "filter_and_or",
    """SELECT o_orderkey FROM orders
WHERE o_orderstatus = 'O' AND (o_totalprice > 400000 OR o_orderpriority = '1-URGENT')""",
)
def filter_and_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parentheses make the alternative part of the conjunction."""
    orders = table(spark, sf_dir, "orders")
    large_or_urgent = (F.col("o_totalprice") > 400000) | (F.col("o_orderpriority") == "1-URGENT")
    return orders.where((F.col("o_orderstatus") == "O") & large_or_urgent).select("o_orderkey")


_LABELLED_SQL = """SELECT d.doc_id, d.lang, l.quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS {test}"""


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return documents.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("filter_null", _LABELLED_SQL.format(test="NULL"))
def filter_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label."""
    return _labelled(spark, sf_dir).where(F.col("quality").isNull())


@query("filter_not_null", _LABELLED_SQL.format(test="NOT NULL"))
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one; Spark turns the outer join into an inner one."""
    return _labelled(spark, sf_dir).where("quality IS NOT NULL")


@query(
    "filter_compare",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity > 25 AND l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'""",
)
def filter_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_quantity > 25 AND l_shipdate >= TIMESTAMP_NTZ '1998-01-01' AND l_returnflag == 'R'")
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@query("filter_in", "SELECT event_id, user_id FROM events WHERE event_type IN ('view', 'click')")
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership in a short list written in the program."""
    events = table(spark, sf_dir, "events")
    return events.where(F.col("event_type").isin("view", "click")).select("event_id", "user_id")


@query(
    "sample_fraction",
    """SELECT event_id, ts FROM events
WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 10""",
)
def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten of a hundred events, chosen by a hash of their id."""
    return sample_by_key(table(spark, sf_dir, "events").select("event_id", "ts"), "event_id", 10)


# --- joins ----------------------------------------------------------------------------------


@query(
    "join_inner",
    """SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
)
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join on a shared column, which appears once. No hint: Spark broadcasts customers below its
    threshold, otherwise a customer with very many orders is split by adaptive execution."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customer = table(spark, sf_dir, "customer")
    return orders.join(customer, "c_custkey").select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query(
    "join_full_outer",
    f"""WITH {UPDATES_SQL}
SELECT COALESCE(c.c_custkey, u.c_custkey) AS c_custkey, c.c_mktsegment AS old_segment,
  u.c_mktsegment AS new_segment, u.c_custkey IS NOT NULL AS updated
FROM customer c FULL OUTER JOIN upd u ON c.c_custkey = u.c_custkey""",
)
def join_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers and all updates, paired by a key that is unique on both sides."""
    old = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("old_segment"))
    new = updates(spark, sf_dir).select(
        "c_custkey", F.col("c_mktsegment").alias("new_segment"), F.lit(True).alias("in_updates")
    )
    return old.join(new, "c_custkey", "outer").select(
        "c_custkey", "old_segment", "new_segment", F.col("in_updates").isNotNull().alias("updated")
    )


@query(
    "interval_join",
    """SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, o.o_orderdate, l.l_shipdate
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
 AND l.l_shipdate >= o.o_orderdate AND l.l_shipdate <= o.o_orderdate + INTERVAL 90 DAY""",
)
def orders_shipped_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines shipped within 90 days of their order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    joined = interval_join(orders, lines, "o_orderkey", "l_orderkey", "o_orderdate", "l_shipdate", timedelta(days=90))
    return joined.drop("l_orderkey")


# --- unions, duplicates, order --------------------------------------------------------------


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(
    "union_positional",
    """SELECT c_custkey AS party_key, c_name AS party_name, c_nationkey AS nation_key FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
)
def union_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns pair by position, names come from the first part, copies stay."""
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS party_key", "c_name AS party_name", "c_nationkey AS nation_key"
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return customer.union(supplier).union(supplier)


@query(
    "union_by_name",
    """SELECT c_custkey AS party_key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns pair by name, absent ones are null."""
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment AS segment", "c_custkey AS party_key", "c_acctbal AS balance"
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS party_key")
    return customer.unionByName(supplier, allowMissingColumns=True)


@query(
    "conform_rows",
    """SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS o_custkey, CAST(NULL AS DOUBLE) AS o_totalprice
FROM orders""",
)
def conform_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a lenient source brought to a schema: what does not convert or is absent is null."""
    orders = table(spark, sf_dir, "orders")
    loose = orders.select(F.col("o_orderpriority").alias("o_custkey"), "o_orderkey")
    wanted = orders.select("o_orderkey", F.col("o_custkey").cast("int"), "o_totalprice").schema
    return conform(loose, wanted)


@query(
    "order_by",
    """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
ORDER BY o_totalprice DESC, o_orderkey""",
)
def order_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice", "o_orderdate")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
    )


@query(
    "first_row",
    """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 1""",
)
def first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of an order; each task keeps only its own first."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1)


@query(
    "row_number_window",
    """SELECT o_orderkey, o_orderdate, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS position
FROM orders""",
)
def row_number_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of every order by date."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return with_row_number(orders, ["o_orderdate", "o_orderkey"], "position", start=1, rows_per_range=ROWS_PER_RANGE)


_MEMBERS_SQL = """SELECT c_custkey, c_name FROM customer c
WHERE {} (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')"""


def _members(spark: SparkSession, sf_dir: str, join) -> DataFrame:
    """Customers with 32-bit keys against orders with 64-bit ones, nothing broadcast."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int"), "c_name")
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    found = join(customer, orders, [("c_custkey", "o_custkey")], broadcast_bytes=0)
    return found.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("semi_shuffled", _MEMBERS_SQL.format("EXISTS"))
def semi_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir, semi_join)


@query("anti_shuffled", _MEMBERS_SQL.format("NOT EXISTS"))
def anti_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir, anti_join)
