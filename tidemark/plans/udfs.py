"""User-defined rules: each as a native expression and as a vectorised UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars, udfs
from ..sources.files import table
from .registry import query

# Keys spread up to sizes whose cube no longer fits into 64 bits.
_SPREAD = 1009

_SQUARE_SQL = f"""SELECT o_orderkey, CAST((o_orderkey * {_SPREAD}) * (o_orderkey * {_SPREAD}) AS BIGINT) AS id_squared
FROM orders"""

_CUBE_SQL = f"""SELECT o_orderkey, TRY_CAST(CAST(o_orderkey * {_SPREAD} AS HUGEINT)
  * CAST(o_orderkey * {_SPREAD} AS HUGEINT) * CAST(o_orderkey * {_SPREAD} AS HUGEINT) AS BIGINT) AS id_cubed
FROM orders"""

_CLASS_SQL = """SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_extendedprice > 20000 THEN 'Large' WHEN l_extendedprice > 10000 THEN 'Medium'
       WHEN l_extendedprice IS NOT NULL THEN 'Low' END AS category
FROM lineitem"""

_CONCAT_SQL = "SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name FROM customer"


def _powers(spark: SparkSession, sf_dir: str, rule, name: str) -> DataFrame:
    spread: Column = F.col("o_orderkey") * _SPREAD
    return table(spark, sf_dir, "orders").select("o_orderkey", rule(spread).alias(name))


def _classes(spark: SparkSession, sf_dir: str, rule) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", rule(F.col("l_extendedprice")).alias("category"))


def _names(spark: SparkSession, sf_dir: str, rule) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", rule(F.col("c_name"), F.col("c_mktsegment")).alias("full_name"))


@query("udf_square", _SQUARE_SQL)
def udf_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _powers(spark, sf_dir, scalars.square, "id_squared")


@query("udf_square_vectorised", _SQUARE_SQL)
def udf_square_vectorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _powers(spark, sf_dir, udfs.square_udf, "id_squared")


@query("udf_cube", _CUBE_SQL)
def udf_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _powers(spark, sf_dir, scalars.cube, "id_cubed")


@query("udf_cube_vectorised", _CUBE_SQL)
def udf_cube_vectorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _powers(spark, sf_dir, udfs.cube_udf, "id_cubed")


@query("udf_categorize", _CLASS_SQL)
def udf_categorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classes(spark, sf_dir, scalars.categorize)


@query("udf_categorize_vectorised", _CLASS_SQL)
def udf_categorize_vectorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classes(spark, sf_dir, udfs.categorize_udf)


@query("udf_concat", _CONCAT_SQL)
def udf_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir, scalars.full_name)


@query("udf_concat_vectorised", _CONCAT_SQL)
def udf_concat_vectorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir, udfs.concatenate_udf)
