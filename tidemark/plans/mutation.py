"""Upsert with schema evolution, update, delete, rewrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import WhenMatched, WhenNotMatched, merge, merge_metrics, observed
from ..operators.mutate import delete_all, delete_where, update_where
from ..operators.rows import changed_rows, hash_of, with_editor, with_row_hash, with_tracking
from ..operators.versions import read_version, write_version
from ..session import materialize, new_path
from ..sources.files import table
from .registry import dates_as_text, query

_UPSERT_SQL = """
WITH tgt AS (SELECT p_partkey, p_name, p_type, p_retailprice FROM part),
src AS (
  SELECT p_partkey, p_name, p_type, p_retailprice + 100 AS p_retailprice, p_brand, p_size
  FROM part WHERE p_type = 'PROMO'
  UNION ALL
  SELECT p_partkey, p_name, 'REWORKED', p_retailprice, p_brand, p_size
  FROM part WHERE p_type = 'SMALL'
  UNION ALL
  SELECT -1 - p_partkey, p_name, p_type, p_retailprice, p_brand, p_size
  FROM part WHERE p_size > 40
)"""


def _upsert(spark: SparkSession, sf_dir: str, key_type: str = "long", **options) -> DataFrame:
    part = table(spark, sf_dir, "part")
    wide = ["p_partkey", "p_name", "p_type", "p_retailprice", "p_brand", "p_size"]
    changed = part.where("p_type = 'PROMO'").withColumn("p_retailprice", F.col("p_retailprice") + 100)
    retyped = part.where("p_type = 'SMALL'").withColumn("p_type", F.lit("REWORKED"))
    added = part.where("p_size > 40").withColumn("p_partkey", -1 - F.col("p_partkey"))
    return merge(
        part.select(wide[:4]).withColumn("p_partkey", F.col("p_partkey").cast(key_type)),
        changed.select(wide).union(retyped.select(wide)).union(added.select(wide)),
        ["P_PARTKEY", "P_TYPE"],
        matched=[WhenMatched()],
        not_matched=[WhenNotMatched()],
        evolve=True,
        with_action=True,
        **options,
    )


_UPSERTED_SQL = f"""{_UPSERT_SQL}
SELECT t.p_partkey, COALESCE(s.p_name, t.p_name) AS p_name, t.p_type,
       COALESCE(s.p_retailprice, t.p_retailprice) AS p_retailprice, s.p_brand, s.p_size
FROM tgt t LEFT JOIN src s ON s.p_partkey = t.p_partkey AND s.p_type = t.p_type
UNION ALL
SELECT s.* FROM src s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE s.p_partkey = t.p_partkey AND s.p_type = t.p_type)"""


@query("merge_upsert_shuffled", _UPSERTED_SQL)
def merge_upsert_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with nothing broadcast, and with 32-bit keys in the target against 64-bit ones."""
    merged = _upsert(spark, sf_dir, "int", broadcast_bytes=0).drop("_action")
    return merged.withColumn("p_partkey", F.col("p_partkey").cast("long"))


@query("merge_upsert_evolve", _UPSERTED_SQL)
def merge_upsert_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert on two keys; the table gains the two columns that only the change set has."""
    return _upsert(spark, sf_dir).drop("_action")


@query(
    "merge_metrics",
    f"""{_UPSERT_SQL}, matched AS (
  SELECT COUNT(*) AS n FROM tgt t JOIN src s ON s.p_partkey = t.p_partkey AND s.p_type = t.p_type
)
SELECT 'updated' AS action, n AS num_rows FROM matched
UNION ALL SELECT 'kept', (SELECT COUNT(*) FROM tgt) - n FROM matched
UNION ALL SELECT 'inserted', (SELECT COUNT(*) FROM src) - n FROM matched""",
)
def upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted by the job that writes the merged table."""
    counts = Observation("upsert")
    materialize(observed(_upsert(spark, sf_dir), counts), "upserted")
    return spark.createDataFrame(list(counts.get.items()), "action string, num_rows long")


@query("merge_actions", f"""{_UPSERT_SQL}, acted AS (
  SELECT CASE WHEN s.p_partkey IS NULL THEN 'kept' WHEN t.p_partkey IS NULL THEN 'inserted' ELSE 'updated' END AS action
  FROM tgt t FULL JOIN src s ON s.p_partkey = t.p_partkey AND s.p_type = t.p_type
)
SELECT action, COUNT(*) AS num_rows FROM acted GROUP BY action""")
def upsert_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a query over the merge."""
    return merge_metrics(_upsert(spark, sf_dir))


@query(
    "update_where",
    """SELECT p_partkey, p_name, p_brand, p_type, p_size,
  CASE WHEN p_type = 'PROMO' THEN p_retailprice * 0.9 ELSE p_retailprice END AS p_retailprice
FROM part""",
)
def update_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten percent off one category."""
    return update_where(
        table(spark, sf_dir, "part"), {"p_retailprice": "p_retailprice * 0.9"}, "p_type == 'PROMO'"
    )


@query("delete_where", "SELECT * FROM part WHERE NOT (p_size < 10) OR p_size IS NULL")
def delete_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_where(table(spark, sf_dir, "part"), "p_size < 10")


@query(
    "delete_all",
    """SELECT 'before' AS moment, COUNT(*) AS num_rows FROM part
UNION ALL SELECT 'after', COUNT(*) FROM part WHERE FALSE""",
)
def empty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts around a delete without condition."""
    part = table(spark, sf_dir, "part")
    count = F.count(F.lit(1)).alias("num_rows")
    before = part.agg(count).select(F.lit("before").alias("moment"), "num_rows")
    after = delete_all(part).agg(count).select(F.lit("after").alias("moment"), "num_rows")
    return before.union(after)


@query(
    "dedupe_rewrite",
    """SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM (
  SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'
) AS copies""",
)
def dedupe_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read a table with repeated rows, drop the copies, write the next version and read it."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    root = new_path(spark, "orders")
    write_version(orders.union(orders.where("o_orderstatus = 'F'")), root, 0)
    write_version(read_version(spark, root, 0).select("*").distinct(), root, 1)
    return read_version(spark, root, 1)


# --- row hashes -----------------------------------------------------------------------------

_HASHED = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


def _hash_sql(type_sql: str = "p_type") -> str:
    texts = [f"CAST({type_sql if c == 'p_type' else c} AS VARCHAR)" for c in _HASHED]
    parts = " || ".join(f"COALESCE(CAST(length({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts)
    return f"sha256({parts})"


@query("row_hash", f"SELECT p_partkey, {_hash_sql()} AS row_key FROM part")
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", hash_of(_HASHED).alias("row_key"))


@query("edited_by_user", "SELECT p_partkey, TRUE AS by_session_user FROM part")
def edited_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the session's user, compared with it, since names differ by session."""
    stamped = with_editor(table(spark, sf_dir, "part"))
    user = spark.sql("SELECT current_user()").first()[0]
    return stamped.select("p_partkey", (F.col("edited_by") == user).alias("by_session_user"))


@query(
    "row_hash_nested",
    """WITH t AS (SELECT p_partkey, p_name AS n, CAST(p_size AS VARCHAR) AS s, p_brand AS b, p_type AS y FROM part)
SELECT p_partkey, sha256('s' || COALESCE(length(n) || ':' || n, '-') || COALESCE(length(s) || ':' || s, '-')
  || 'a2:' || COALESCE(length(b) || ':' || b, '-') || COALESCE(length(y) || ':' || y, '-')) AS row_key FROM t""",
)
def row_hash_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash of a struct and an array, by their canonical texts."""
    part = table(spark, sf_dir, "part")
    nested = part.select("p_partkey", F.struct("p_name", "p_size").alias("label"), F.array("p_brand", "p_type").alias("kinds"))
    return with_row_hash(nested, ["label", "kinds"]).select("p_partkey", "row_key")


@query(
    "tracking_columns",
    f"""SELECT *, {_hash_sql()} AS row_key, TRUE AS is_current, CAST(NULL AS VARCHAR) AS end_date,
  FALSE AS delete_flag
FROM part""",
)
def tracking_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(with_tracking(with_row_hash(table(spark, sf_dir, "part"), _HASHED)))


@query(
    "hash_change_detect",
    f"""SELECT p_partkey, 'REVISED' AS p_type, {_hash_sql()} AS row_key,
  {_hash_sql("'REVISED'")} AS new_row_key
FROM part WHERE p_brand = 'Brand#12'""",
)
def hash_change_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change one column in some rows, then find them by their outdated hash."""
    hashed = with_row_hash(table(spark, sf_dir, "part"), _HASHED)
    edited = hashed.withColumn(
        "p_type", F.when(F.col("p_brand") == "Brand#12", "REVISED").otherwise(F.col("p_type"))
    )
    return changed_rows(edited, _HASHED).select("p_partkey", "p_type", "row_key", "new_row_key")
