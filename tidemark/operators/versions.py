"""Point-in-time reads over a change log, and tables kept as numbered versions.

A change log holds the rows of a table with ``_version``, ``_commit_ts`` and ``_op`` (insert,
update or delete); a key changes at most once per version. Commit times are in UTC; a moment with a zone is converted.

A stored log (:func:`append_commit`) has a folder for each version, and a snapshot of the whole table every so
many versions (:func:`write_snapshot`). :func:`state_at` reads the last snapshot before the point asked for, and of the log only the
folders between the two.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .names import private, quoted
from .sizing import BROADCAST_BYTES, broadcast_if_small

VERSION = "_version"
COMMITTED = "_commit_ts"
OPERATION = "_op"
LOG_COLUMNS = (VERSION, COMMITTED, OPERATION)


def _utc(moment: datetime) -> Column:
    """A moment on the clock of the log; one without a zone is taken for UTC."""
    plain = moment if moment.tzinfo is None else moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(plain.isoformat(sep=" ")).cast("timestamp_ntz")


def commit(rows: DataFrame, version: int, committed: datetime, operation: str) -> DataFrame:
    """Rows as one commit of a change log."""
    return rows.withColumns({VERSION: F.lit(version), COMMITTED: _utc(committed), OPERATION: F.lit(operation)})


def as_of(
    changes: DataFrame,
    keys: Sequence[str],
    version: int | None = None,
    timestamp: datetime | None = None,
) -> DataFrame:
    """The table as it was at ``version``, or at the last commit not after ``timestamp``; without
    either, as it is now.

    The latest change per key is a partial aggregate: a key with many changes leaves each task
    once. Each column is its own ``max_by``, so rows of fixed width are aggregated by hashing, and
    nothing is sorted.
    """
    if version is not None and timestamp is not None:
        raise ValueError("give a version or a timestamp, not both")
    seen = changes
    if version is not None:
        seen = changes.where(F.col(VERSION) <= version)
    if timestamp is not None:
        seen = changes.where(F.col(COMMITTED) <= _utc(timestamp))
    if seen is not changes and seen.select(VERSION).isEmpty():
        raise ValueError("the table has no commit at or before the point asked for")

    gone = private(changes.columns, "_gone")
    return _latest(seen, keys, gone).where(~F.col(gone)).select(*(quoted(c) for c in changes.columns if c not in LOG_COLUMNS))


def _latest(changes: DataFrame, keys: Sequence[str], gone: str) -> DataFrame:
    """The last change of each key; ``gone`` tells whether it is a deletion."""
    values = [c for c in changes.columns if c not in keys and c not in LOG_COLUMNS]
    deleted = F.max_by(F.col(OPERATION) == "delete", VERSION).alias(gone)
    return changes.groupBy(*map(quoted, keys)).agg(deleted, *(F.max_by(quoted(c), VERSION).alias(c) for c in values))


def commit_merge(merged: DataFrame, version: int, committed: datetime, action: str = "_action") -> DataFrame:
    """What a merge did, as one commit of a change log: the rows that it inserted and updated.

    ``merged`` is the result of a merge with ``with_action=True``.
    """
    changed = merged.where(F.col(action).isin("inserted", "updated"))
    operation = F.when(F.col(action) == "inserted", "insert").otherwise("update")
    return commit(changed, version, committed, "update").withColumn(OPERATION, operation).drop(action)


def history(changes: DataFrame) -> DataFrame:
    """One row per commit with the rows it inserted, updated and deleted."""

    def rows(operation: str) -> Column:
        return F.count(F.when(F.col(OPERATION) == operation, 1))

    return changes.groupBy(
        F.col(VERSION).alias("version"), F.col(COMMITTED).alias("committed")
    ).agg(
        rows("insert").alias("rows_inserted"),
        rows("update").alias("rows_updated"),
        rows("delete").alias("rows_deleted"),
    )


def append_commit(rows: DataFrame, root: str, version: int, committed: datetime, operation: str | None = None) -> None:
    """Write one commit to a stored log, in a folder of its own that must not exist yet. ``rows`` say themselves what happened to them
    (``_op``) unless one ``operation`` is given. The commit counts once its entry in ``commits`` is written, after its rows."""
    spark = rows.sparkSession
    made = rows if operation is None else rows.withColumn(OPERATION, F.lit(operation))
    made.select(*(quoted(c) for c in made.columns if c not in (VERSION, COMMITTED))).write.parquet(f"{root}/log/{VERSION}={version}")
    entry = spark.range(1).select(_utc(committed).alias(COMMITTED))
    entry.coalesce(1).write.parquet(f"{root}/commits/{VERSION}={version}")


def write_snapshot(spark: SparkSession, root: str, keys: Sequence[str], version: int) -> None:
    """Write the whole table as of ``version`` beside the log, for reads of later points. It is used once its entry in
    ``snapshot_list`` is written, after its rows."""
    state_at(spark, root, keys, version).write.parquet(f"{root}/snapshots/{VERSION}={version}")
    spark.range(1).coalesce(1).write.parquet(f"{root}/snapshot_list/{VERSION}={version}")


def _versions(spark: SparkSession, folder: str) -> DataFrame | None:
    """The entries of a list with a folder for each version, or None without any."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def state_at(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    version: int | None = None,
    timestamp: datetime | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The table of a stored log as it was at ``version``, or at the last commit not after ``timestamp``; without
    either, as it is now.

    The point and the last snapshot up to it are looked up in two small lists. Filters on the version then
    leave only the folders of that snapshot and of the commits after it to be read. Rows of the snapshot whose keys
    changed since give way to the last change; the keys are broadcast if they are measured as small, so that the snapshot is not
    shuffled. Without a snapshot the log is read from its start.
    """
    if version is not None and timestamp is not None:
        raise ValueError("give a version or a timestamp, not both")
    commits = _versions(spark, f"{root}/commits")
    if commits is not None and version is not None:
        commits = commits.where(F.col(VERSION) <= version)
    if commits is not None and timestamp is not None:
        commits = commits.where(F.col(COMMITTED) <= _utc(timestamp))
    last = None if commits is None else commits.agg(F.max(VERSION)).first()[0]
    if last is None:
        raise ValueError("the table has no commit at or before the point asked for")
    taken = _versions(spark, f"{root}/snapshot_list")
    base = None if taken is None else taken.where(F.col(VERSION) <= last).agg(F.max(VERSION)).first()[0]

    log = spark.read.parquet(f"{root}/log")
    kept = [c for c in log.columns if c not in LOG_COLUMNS]
    gone = private(log.columns, "_gone")
    since = F.col(VERSION) <= last if base is None else (F.col(VERSION) > base) & (F.col(VERSION) <= last)
    latest = _latest(log.where(since), keys, gone)
    alive = latest.where(~F.col(gone)).select(*map(quoted, kept))
    if base is None:
        return alive
    snapshot = spark.read.parquet(f"{root}/snapshots").where(F.col(VERSION) == base)
    changed = broadcast_if_small(log.where(since).select(*map(quoted, keys)).distinct(), broadcast_bytes).alias("c")
    same = reduce(and_, (F.col(f"s.{quoted(k)}").eqNullSafe(F.col(f"c.{quoted(k)}")) for k in keys))
    unchanged = snapshot.alias("s").join(changed, same, "left_anti").select(*map(quoted, kept))
    return unchanged.unionByName(alive)


def version_path(root: str, version: int) -> str:
    return f"{root}/version={version}"


def write_version(df: DataFrame, root: str, version: int) -> None:
    """Write a table under its next version number. Older versions stay, so the plan may read
    them, and a failed write leaves the table as it was."""
    df.write.parquet(version_path(root, version))


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(version_path(root, version))
