"""Write modes, schema rules on append, overwriting a catalog table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import writes
from ..operators.merge import WhenMatched, WhenNotMatched
from ..operators.merge_table import merge_table
from ..operators.numbering import with_row_number
from ..operators.schema import SchemaMismatch, enforce
from ..session import materialize, new_path
from ..sources.files import table
from .catalogs import catalog_table
from .inputs import ROWS_PER_RANGE
from .registry import query

_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]
_OLD = "o_orderdate < TIMESTAMP '1998-01-01'"
_NEW = "o_orderdate >= TIMESTAMP '1998-01-01'"


def _orders(spark: SparkSession, sf_dir: str, condition: str = "TRUE") -> DataFrame:
    return table(spark, sf_dir, "orders").where(condition.replace("TIMESTAMP ", "TIMESTAMP_NTZ "))


@query("write_errorifexists", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def write_errorifexists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first write creates the table, the second one is refused and changes nothing."""
    path = new_path(spark, "created")
    orders = _orders(spark, sf_dir).select(_COLUMNS)
    writes.create(orders, path)
    try:
        writes.create(orders, path)
    except AnalysisException:
        return writes.read(spark, path)
    raise AssertionError("a write over an existing table was accepted")


@query("write_overwrite", f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {_NEW}")
def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "overwritten")
    writes.create(_orders(spark, sf_dir, _OLD).select(_COLUMNS), path)
    writes.overwrite(_orders(spark, sf_dir, _NEW).select(_COLUMNS), path)
    return writes.read(spark, path)


@query("write_append", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns are appended by name, whatever their order."""
    path = new_path(spark, "appended")
    writes.create(_orders(spark, sf_dir, _OLD).select(_COLUMNS), path)
    writes.append(_orders(spark, sf_dir, _NEW).select(_COLUMNS[::-1]), path)
    return writes.read(spark, path)


@query("enforce_schema", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def enforce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conforming rows pass, in the order of the schema, also where it forbids nulls; rows with a
    null there do not."""
    wanted = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("o_custkey", T.LongType(), False),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    )
    orders = _orders(spark, sf_dir).select(_COLUMNS[::-1])
    gaps = orders.withColumn("o_custkey", F.expr("nullif(o_custkey, o_custkey)"))
    try:
        enforce(gaps, wanted)
    except SchemaMismatch:
        return enforce(orders, wanted)
    raise AssertionError("nulls were accepted")


@query("append_rejected", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def append_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with another set of columns, with another type, and with a null where the table has none (which
    takes reading them) leave the table as it was."""
    path = new_path(spark, "strict")
    orders = _orders(spark, sf_dir)
    known = F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey")  # never null
    writes.create(orders.select(known, *_COLUMNS[1:]), path)
    for rows in (
        orders.select("o_orderkey", "o_orderpriority"),
        orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("string")),
        orders.select(F.expr("nullif(o_orderkey, o_custkey - o_custkey + 1)").alias("o_orderkey"), *_COLUMNS[1:]),
    ):
        try:
            writes.append(rows, path)
        except SchemaMismatch:
            continue
        raise AssertionError(f"{rows.schema.simpleString()} was appended")
    return writes.read(spark, path)


@query(
    "append_evolve",
    f"""SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE {_OLD}
UNION ALL
SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE {_NEW}""",
)
def append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The appended rows bring a new column and lack an old one."""
    path = new_path(spark, "evolving")
    writes.create(_orders(spark, sf_dir, _OLD).select("o_orderkey", "o_totalprice"), path)
    writes.append_evolving(_orders(spark, sf_dir, _NEW).select("o_orderkey", "o_orderpriority"), path)
    return writes.read(spark, path)


@query(
    "append_evolve_nested",
    f"""SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS customer, CAST(NULL AS VARCHAR) AS priority, o_totalprice AS price
FROM orders WHERE {_OLD}
UNION ALL
SELECT o_orderkey, o_custkey * 10000000000, o_orderpriority, o_totalprice FROM orders WHERE {_NEW}""",
)
def append_evolve_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The appended rows bring a field of a nested column, in another order, and a wider number."""
    path = new_path(spark, "evolving-nested")
    old, new = _orders(spark, sf_dir, _OLD), _orders(spark, sf_dir, _NEW)
    customer = F.col("o_custkey").cast("int").alias("customer")
    writes.create(old.select("o_orderkey", F.struct(customer, F.col("o_totalprice").alias("price")).alias("detail")), path)
    wide = (F.col("o_custkey") * 10_000_000_000).alias("customer")
    detail = F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"), wide)
    writes.append_evolving(new.select(detail.alias("detail"), "o_orderkey"), path)
    return writes.read(spark, path).select("o_orderkey", "detail.customer", "detail.priority", "detail.price")


_BY_PRIORITY = [*_COLUMNS, "o_orderpriority"]


@query(
    "replace_partitioned",
    """SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '0-NOW' ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderpriority IS NULL""",
)
def replace_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a partitioned catalog table by a query over itself: one partition goes, one changes its name."""
    orders = table(spark, sf_dir, "orders").select(_BY_PRIORITY)
    with catalog_table(orders, "orders_by_priority", ["o_orderpriority"]) as name:
        kept = spark.table(name).where("o_orderpriority <> '5-LOW' OR o_orderpriority IS NULL")
        renamed = F.when(F.col("o_orderpriority") == "1-URGENT", "0-NOW").otherwise(F.col("o_orderpriority"))
        writes.replace_table(kept.select(*_COLUMNS[:2], F.col("o_totalprice") + 1, renamed), name)
        return materialize(spark.table(name), "replaced-rows")


@query(
    "merge_touched_partitions",
    """SELECT o_orderkey, o_custkey, o_totalprice + CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN 10 ELSE 0 END
  AS o_totalprice, o_orderpriority FROM orders
UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice, '6-NEW' FROM orders WHERE o_orderstatus = 'P'""",
)
def merge_touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates in one partition and rows for a new one; the other partitions are not rewritten."""
    orders = table(spark, sf_dir, "orders")
    dearer = orders.where("o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 10)
    new = orders.where("o_orderstatus = 'P'").withColumns({"o_orderkey": -F.col("o_orderkey"), "o_orderpriority": F.lit("6-NEW")})
    changes = dearer.select(_BY_PRIORITY).union(new.select(_BY_PRIORITY))
    with catalog_table(orders.select(_BY_PRIORITY), "orders_by_priority", ["o_orderpriority"]) as name:
        merge_table(changes, name, "o_orderkey", [WhenMatched()], [WhenNotMatched()])
        return materialize(spark.table(name), "merged-rows")


@query(
    "insert_overwrite",
    """SELECT ROW_NUMBER() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS id, c_custkey, c_name, c_acctbal
FROM customer""",
)
def insert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a catalog table by a query over itself."""
    customer = table(spark, sf_dir, "customer").select(
        F.lit(None).cast("long").alias("id"), "c_custkey", "c_name", "c_acctbal"
    )
    with catalog_table(customer, "customer_numbered") as name:
        order = ["c_acctbal", "c_custkey"]
        numbered = with_row_number(spark.table(name), order, "new_id", rows_per_range=ROWS_PER_RANGE)
        writes.replace_table(numbered.select("new_id", "c_custkey", "c_name", "c_acctbal"), name)
        return spark.table(name)
