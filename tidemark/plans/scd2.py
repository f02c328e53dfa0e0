"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scd2
from ..operators.joins import anti_join
from ..operators.merge import WhenMatched, WhenNotMatched, merge
from ..operators.numbering import number_new_rows, with_row_number
from ..operators.scd2_history import apply_history, merge_history
from ..operators.writes import replace_table
from ..session import materialize
from ..sources.files import table
from .catalogs import catalog_table
from .inputs import (
    DIMENSION_SQL,
    MODIFICATIONS_SQL,
    ROWS_PER_RANGE,
    SURROGATE_SQL,
    TRACKED,
    UPDATES_SQL,
    date,
    dimension,
    incoming,
    modifications,
    surrogate_dimension,
    updates,
)
from .registry import dates_as_text, query

_KEY = "c_custkey"

# --- several updates of a key, and late ones --------------------------------------------------


def _history_sql(updates_sql: str) -> str:
    """Changes at any time, without gaps in the dimension: every change point of a key once more in order."""
    return f"""
WITH {DIMENSION_SQL}, upd AS ({updates_sql}),
points AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, effective_date, end_date, 0 AS u FROM dim
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment, effective_date, NULL, 1 FROM upd),
told AS (
  SELECT *, LAG(c_nationkey) OVER k AS old_nation, LAG(c_mktsegment) OVER k AS old_segment, COUNT(*) OVER k AS nth,
    MAX(CASE WHEN u = 0 THEN effective_date END) OVER k AS held_from
  FROM points WINDOW k AS (PARTITION BY c_custkey ORDER BY effective_date, u ROWS UNBOUNDED PRECEDING)),
kept AS (SELECT * FROM told WHERE u = 0 OR nth = 1 OR c_nationkey IS DISTINCT FROM old_nation OR c_mktsegment IS DISTINCT FROM old_segment),
ended AS (
  SELECT k.*, LEAD(k.effective_date) OVER (PARTITION BY k.c_custkey ORDER BY k.effective_date, k.u) AS next
  FROM kept k)
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(effective_date AS VARCHAR) AS effective_date,
  CAST(COALESCE(next, end_date) AS VARCHAR) AS end_date, COALESCE(next, end_date) IS NULL AS is_current
FROM ended"""


_CHAIN_SQL = _history_sql("""
  SELECT c_custkey, c_name, c_nationkey, 'FIRST' AS c_mktsegment, DATE '2000-01-01' AS effective_date FROM customer WHERE c_acctbal < 3000
  UNION ALL SELECT c_custkey, c_name, c_nationkey + 1, 'FIRST', DATE '2001-06-01' FROM customer WHERE c_acctbal < 2000
  UNION ALL SELECT c_custkey, c_name, c_nationkey + 1, CASE WHEN c_acctbal < 0 THEN NULL ELSE 'FIRST' END, DATE '2002-01-01'
  FROM customer WHERE c_acctbal < 2000
  UNION ALL SELECT -1 - c_custkey, c_name, c_nationkey, 'NEW', DATE '2000-01-01' FROM customer WHERE c_acctbal >= 9000
  UNION ALL SELECT -1 - c_custkey, c_name, c_nationkey, 'NEWER', DATE '2000-02-01' FROM customer WHERE c_acctbal >= 9000""")


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three updates a key, of which some repeat what is in force; two for each new key."""
    customer = table(spark, sf_dir, "customer")

    def rows(condition, segment, start, key="c_custkey", nation="c_nationkey"):
        return customer.where(condition).select(
            F.expr(key).alias("c_custkey"), "c_name", F.expr(nation).alias("c_nationkey"), F.expr(segment).alias("c_mktsegment"), date(start).alias("effective_date")
        )

    return (
        rows("c_acctbal < 3000", "'FIRST'", "2000-01-01")
        .union(rows("c_acctbal < 2000", "'FIRST'", "2001-06-01", nation="c_nationkey + 1"))
        .union(rows("c_acctbal < 2000", "if(c_acctbal < 0, NULL, 'FIRST')", "2002-01-01", nation="c_nationkey + 1"))
        .union(rows("c_acctbal >= 9000", "'NEW'", "2000-01-01", "-1 - c_custkey"))
        .union(rows("c_acctbal >= 9000", "'NEWER'", "2000-02-01", "-1 - c_custkey"))
    )


@query("scd2_chain", _CHAIN_SQL)
def scd2_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several updates a key in one change set, spliced onto the open version."""
    return dates_as_text(apply_history(dimension(spark, sf_dir), _chain(spark, sf_dir), _KEY, TRACKED))


@query("scd2_chain_merge", _CHAIN_SQL)
def scd2_chain_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a staged merge."""
    return dates_as_text(merge_history(dimension(spark, sf_dir), _chain(spark, sf_dir), _KEY, TRACKED))


_BACKDATED_SQL = _history_sql("""
  SELECT c_custkey, c_name, c_nationkey, 'LATE' AS c_mktsegment, DATE '1992-07-01' AS effective_date FROM customer WHERE c_acctbal >= 4000
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment, DATE '1994-01-01' FROM customer WHERE c_acctbal >= 6000
  UNION ALL SELECT c_custkey, c_name, c_nationkey, 'FIRST OF ALL', DATE '1985-01-01' FROM customer WHERE c_acctbal >= 7000
  UNION ALL SELECT c_custkey, c_name, c_nationkey, 'CORRECTED', DATE '1995-01-01' FROM customer WHERE c_acctbal >= 8000""")


def _backdated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates from before the open version: into a closed one, before all versions, and at a version's start."""
    customer = table(spark, sf_dir, "customer")

    def rows(least, segment, start):
        columns = ("c_custkey", "c_name", "c_nationkey", F.expr(segment).alias("c_mktsegment"), date(start).alias("effective_date"))
        return customer.where(F.col("c_acctbal") >= least).select(*columns)

    first, second = rows(4000, "'LATE'", "1992-07-01"), rows(6000, "c_mktsegment", "1994-01-01")
    return first.union(second).union(rows(7000, "'FIRST OF ALL'", "1985-01-01")).union(rows(8000, "'CORRECTED'", "1995-01-01"))


@query("scd2_backdated", _BACKDATED_SQL)
def scd2_backdated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late updates split the version that holds their date."""
    return dates_as_text(apply_history(dimension(spark, sf_dir), _backdated(spark, sf_dir), _KEY, TRACKED))


@query("scd2_backdated_merge", _BACKDATED_SQL)
def scd2_backdated_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a staged merge."""
    return dates_as_text(merge_history(dimension(spark, sf_dir), _backdated(spark, sf_dir), _KEY, TRACKED))


_CHANGED_SQL = """
changed AS (
  SELECT DISTINCT u.* FROM upd u JOIN dim d ON u.c_custkey = d.c_custkey
  WHERE d.is_current AND (u.c_nationkey IS DISTINCT FROM d.c_nationkey
                          OR u.c_mktsegment IS DISTINCT FROM d.c_mktsegment)
)"""

_MERGED_SQL = f"""
WITH {DIMENSION_SQL}, {UPDATES_SQL}, {_CHANGED_SQL}
SELECT d.c_custkey, d.c_name, d.c_nationkey, d.c_mktsegment,
       CAST(d.effective_date AS VARCHAR) AS effective_date,
       CAST(CASE WHEN d.is_current AND c.c_custkey IS NOT NULL THEN c.effective_date
                 ELSE d.end_date END AS VARCHAR) AS end_date,
       d.is_current AND c.c_custkey IS NULL AS is_current
FROM dim d LEFT JOIN changed c ON d.c_custkey = c.c_custkey
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(effective_date AS VARCHAR), NULL, TRUE
FROM changed
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(effective_date AS VARCHAR), NULL, TRUE
FROM upd WHERE c_custkey NOT IN (SELECT c_custkey FROM dim)
"""


@query("scd2_staged_merge", _MERGED_SQL)
def scd2_staged_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Close changed versions and insert their successors through a staged merge."""
    return dates_as_text(
        scd2.merge_changes(dimension(spark, sf_dir), updates(spark, sf_dir), _KEY, TRACKED)
    )


@query("scd2_apply", _MERGED_SQL)
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table in one pass over the dimension."""
    return dates_as_text(
        scd2.apply_changes(dimension(spark, sf_dir), updates(spark, sf_dir), _KEY, TRACKED)
    )


@query("scd2_apply_shuffled", _MERGED_SQL)
def scd2_apply_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with nothing broadcast, and with 32-bit keys in the dimension against 64-bit ones."""
    target = dimension(spark, sf_dir).withColumn(_KEY, F.col(_KEY).cast("int"))
    applied = scd2.apply_changes(target, updates(spark, sf_dir), _KEY, TRACKED, broadcast_bytes=0)
    return dates_as_text(applied.withColumn(_KEY, F.col(_KEY).cast("long")))


_REOPENED_SQL = f"""
WITH {DIMENSION_SQL}, {UPDATES_SQL}, part_open AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, effective_date,
         CASE WHEN c_nationkey % 3 = 0 AND is_current THEN DATE '1998-01-01' ELSE end_date END AS end_date,
         is_current AND c_nationkey % 3 <> 0 AS is_current
  FROM dim
), hit AS (
  SELECT u.* FROM upd u JOIN part_open d ON u.c_custkey = d.c_custkey
  WHERE d.is_current AND (u.c_nationkey IS DISTINCT FROM d.c_nationkey
                          OR u.c_mktsegment IS DISTINCT FROM d.c_mktsegment)
)
SELECT d.c_custkey, d.c_name, d.c_nationkey, d.c_mktsegment,
       CAST(d.effective_date AS VARCHAR) AS effective_date,
       CAST(CASE WHEN d.is_current AND h.c_custkey IS NOT NULL THEN h.effective_date
                 ELSE d.end_date END AS VARCHAR) AS end_date,
       d.is_current AND h.c_custkey IS NULL AS is_current
FROM part_open d LEFT JOIN hit h ON d.c_custkey = h.c_custkey
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(effective_date AS VARCHAR), NULL, TRUE
FROM hit
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(effective_date AS VARCHAR), NULL, TRUE
FROM upd WHERE c_custkey NOT IN (SELECT c_custkey FROM part_open WHERE is_current)
"""


def _partly_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension with the current versions of every third nation closed."""
    ended = F.col("is_current") & (F.col("c_nationkey") % 3 == 0)
    return dimension(spark, sf_dir).withColumns(
        {
            "end_date": F.when(ended, date("1998-01-01")).otherwise(F.col("end_date")),
            "is_current": F.col("is_current") & ~ended,
        }
    )


@query("scd2_reopen", _REOPENED_SQL)
def scd2_reopen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates for keys whose versions are all closed open a new one."""
    return dates_as_text(
        scd2.apply_changes(_partly_open(spark, sf_dir), updates(spark, sf_dir), _KEY, TRACKED)
    )


@query("scd2_reopen_staged", _REOPENED_SQL)
def scd2_reopen_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a staged merge."""
    return dates_as_text(
        scd2.merge_changes(_partly_open(spark, sf_dir), updates(spark, sf_dir), _KEY, TRACKED)
    )


@query(
    "scd2_stage_changed",
    f"""WITH {DIMENSION_SQL}, {UPDATES_SQL}, {_CHANGED_SQL}
SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
       CAST(effective_date AS VARCHAR) AS effective_date, CAST(NULL AS BIGINT) AS merge_key
FROM changed""",
)
def scd2_stage_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(
        scd2.stage_changed(updates(spark, sf_dir), dimension(spark, sf_dir), _KEY, TRACKED)
    )


@query(
    "new_keys_anti",
    f"""WITH {DIMENSION_SQL}, {UPDATES_SQL}
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(effective_date AS VARCHAR) AS effective_date
FROM upd u WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.c_custkey = u.c_custkey)""",
)
def new_keys_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates for keys that the dimension lacks."""
    return dates_as_text(anti_join(updates(spark, sf_dir), dimension(spark, sf_dir), [_KEY]))


_CLOSINGS_SQL = """
closings AS (
  SELECT DISTINCT * FROM mods
  WHERE end_date IS NOT NULL AND c_custkey IN (SELECT c_custkey FROM dim)
)"""


@query(
    "scd2_stage_updates",
    f"""WITH {DIMENSION_SQL}, {MODIFICATIONS_SQL}, {_CLOSINGS_SQL}
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(effective_date AS VARCHAR) AS effective_date,
       CAST(end_date AS VARCHAR) AS end_date, is_current, c_custkey AS merge_key
FROM closings""",
)
def scd2_stage_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(
        scd2.stage_closings(modifications(spark, sf_dir), dimension(spark, sf_dir), _KEY, "end_date")
    )


@query(
    "scd2_stage_inserts",
    f"""WITH {MODIFICATIONS_SQL}
SELECT DISTINCT c_custkey, c_name, c_nationkey, c_mktsegment,
       CAST(effective_date AS VARCHAR) AS effective_date, CAST(end_date AS VARCHAR) AS end_date,
       is_current, CAST(NULL AS BIGINT) AS merge_key
FROM mods WHERE is_current""",
)
def scd2_stage_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(scd2.stage_openings(modifications(spark, sf_dir), _KEY, "is_current"))


@query(
    "scd2_close_and_insert",
    f"""WITH {DIMENSION_SQL}, {MODIFICATIONS_SQL}, {_CLOSINGS_SQL}, hits AS (
  SELECT d.*, c.end_date AS closed_at,
         d.is_current AND NOT c.is_current AND c.end_date > d.effective_date AS hit
  FROM dim d LEFT JOIN closings c ON d.c_custkey = c.c_custkey
)
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(effective_date AS VARCHAR) AS effective_date,
       CAST(CASE WHEN hit THEN closed_at ELSE end_date END AS VARCHAR) AS end_date,
       CASE WHEN hit THEN FALSE ELSE is_current END AS is_current
FROM hits
UNION ALL
SELECT DISTINCT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(effective_date AS VARCHAR),
       CAST(end_date AS VARCHAR), is_current
FROM mods WHERE is_current""",
)
def scd2_close_and_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional close and conditional insert: the change rows carry their own end date."""
    target, changes = dimension(spark, sf_dir), modifications(spark, sf_dir)
    staged = scd2.stage_openings(changes, _KEY, "is_current").unionByName(
        scd2.stage_closings(changes, target, _KEY, "end_date")
    )
    merged = merge(
        target,
        staged,
        [(_KEY, scd2.MERGE_KEY)],
        matched=[
            WhenMatched(
                {"is_current": "false", "end_date": "staged.end_date"},
                "dim.is_current AND NOT staged.is_current AND staged.end_date > dim.effective_date",
            )
        ],
        not_matched=[WhenNotMatched({c: f"staged.{c}" for c in target.columns}, "staged.is_current")],
        aliases=("dim", "staged"),
    )
    return dates_as_text(merged)


def _merged_by_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_by_surrogate(surrogate_dimension(spark, sf_dir), incoming(spark, sf_dir))


def _merge_by_surrogate(target: DataFrame, fresh: DataFrame) -> DataFrame:
    new_versions = fresh.select(
        F.lit(None).cast("long").alias("id"),
        *fresh.columns,
        date("2000-01-01").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
    )
    change_rows = new_versions.unionByName(
        scd2.matching_versions(target, fresh, _KEY), allowMissingColumns=True
    )
    return merge(
        target,
        change_rows,
        "id",
        matched=[WhenMatched({"t.end_date": date("2000-01-01")}, "t.end_date IS NULL")],
        not_matched=[WhenNotMatched()],
    )


@query(
    "scd2_by_surrogate",
    f"""WITH {SURROGATE_SQL}
SELECT id, c_custkey, c_name, c_mktsegment, CAST(start_date AS VARCHAR) AS start_date,
       CAST(end_date AS VARCHAR) AS end_date
FROM merged""",
)
def scd2_by_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge by surrogate id: open versions of incoming keys end, rows without id are inserted."""
    return dates_as_text(_merged_by_surrogate(spark, sf_dir))


_RENUMBERED_SQL = f"""WITH {SURROGATE_SQL}
SELECT ROW_NUMBER() OVER (ORDER BY id NULLS LAST, c_custkey, start_date) - 1 AS id,
       c_custkey, c_name, c_mktsegment, CAST(start_date AS VARCHAR) AS start_date,
       CAST(end_date AS VARCHAR) AS end_date
FROM merged"""


def _renumbered(merged: DataFrame) -> DataFrame:
    """Dense ids from 0: known ids first, new rows after them by business key."""
    numbered = with_row_number(merged, ["id", _KEY, "start_date"], "new_id", rows_per_range=ROWS_PER_RANGE)
    return numbered.withColumn("id", F.col("new_id")).drop("new_id")


@query(
    "number_new_ids",
    f"""WITH {SURROGATE_SQL}
SELECT COALESCE(id, (SELECT MAX(id) FROM merged) + ROW_NUMBER() OVER (PARTITION BY id IS NULL ORDER BY c_custkey)) AS id,
       c_custkey, c_name, c_mktsegment, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
FROM merged""",
)
def number_new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known ids stay; new versions get the ones after the greatest, by business key."""
    merged = materialize(_merged_by_surrogate(spark, sf_dir), "merged")
    return dates_as_text(number_new_rows(merged, "id", [_KEY], rows_per_range=ROWS_PER_RANGE))


@query("renumber_ids", _RENUMBERED_SQL)
def renumber_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged dimension, written once and numbered anew."""
    merged = materialize(_merged_by_surrogate(spark, sf_dir), "merged")
    return dates_as_text(_renumbered(merged))


@query("scd2_catalog_table", _RENUMBERED_SQL)
def scd2_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a catalog table: merged, written aside and numbered, written beside the table and
    put in its place."""
    with catalog_table(surrogate_dimension(spark, sf_dir), "scd_type2") as name:
        merged = materialize(_merge_by_surrogate(spark.table(name), incoming(spark, sf_dir)), "merged")
        replace_table(_renumbered(merged), name)
        return dates_as_text(spark.table(name))


@query(
    "semi_existing",
    f"""WITH {SURROGATE_SQL}
SELECT id, c_custkey, c_name, c_mktsegment, CAST(start_date AS VARCHAR) AS start_date,
       CAST(end_date AS VARCHAR) AS end_date
FROM sdim WHERE c_custkey IN (SELECT c_custkey FROM incoming)""",
)
def semi_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the incoming keys."""
    return dates_as_text(
        scd2.matching_versions(surrogate_dimension(spark, sf_dir), incoming(spark, sf_dir), _KEY)
    )


def _split_sql(test: str) -> str:
    return f"""WITH {DIMENSION_SQL}
SELECT c_custkey, c_mktsegment, CAST(effective_date AS VARCHAR) AS effective_date,
       CAST(end_date AS VARCHAR) AS end_date
FROM dim WHERE end_date {test}"""


_SPLIT_COLUMNS = ["c_custkey", "c_mktsegment", "effective_date", "end_date"]


@query("scd2_active", _split_sql("IS NULL"))
def scd2_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(scd2.active(dimension(spark, sf_dir)).select(_SPLIT_COLUMNS))


@query("scd2_inactive", _split_sql("IS NOT NULL"))
def scd2_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_as_text(scd2.inactive(dimension(spark, sf_dir)).select(_SPLIT_COLUMNS))


@query(
    "null_compare_zero",
    f"""WITH {DIMENSION_SQL}
SELECT CASE WHEN end_date <> effective_date THEN 'true' WHEN NOT (end_date <> effective_date) THEN 'false'
       ELSE 'unknown' END AS differs, COUNT(*) AS n
FROM dim GROUP BY 1""",
)
def null_compare_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comparison with a null end date is neither true nor false."""
    test = F.col("end_date") != F.col("effective_date")
    differs = F.when(test, "true").when(~test, "false").otherwise("unknown").alias("differs")
    return dimension(spark, sf_dir).groupBy(differs).agg(F.count(F.lit(1)).alias("n"))
