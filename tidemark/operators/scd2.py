"""Slowly changing dimensions, type 2.

Two ways lead to the same table: staging a change set with a nullable merge key and merging it, or
:func:`apply_changes`, which closes and re-opens versions in a single pass over the target.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .joins import anti_join, differs, join_members, same_key, semi_join
from .merge import AmbiguousMergeError, WhenMatched, WhenNotMatched, merge
from .names import quoted
from .sizing import BROADCAST_BYTES, ChangeSetSize, broadcast_if_small, is_small, measure_change_set

MERGE_KEY = "merge_key"


@dataclass(frozen=True)
class Validity:
    """Names of the columns that carry a version's validity."""

    start: str = "effective_date"
    end: str = "end_date"
    current: str = "is_current"


DEFAULT = Validity()


def active(dimension: DataFrame, end: str = DEFAULT.end) -> DataFrame:
    return dimension.where(F.col(end).isNull())


def inactive(dimension: DataFrame, end: str = DEFAULT.end) -> DataFrame:
    return dimension.where(F.col(end).isNotNull())


def stage_changed(
    updates: DataFrame,
    dimension: DataFrame,
    key: str,
    tracked: Sequence[str],
    validity: Validity = DEFAULT,
    broadcast_bytes: int = BROADCAST_BYTES,
    stale: str = "refuse",
) -> DataFrame:
    """Updates whose tracked columns differ from the current version, with a null merge key: the
    merge will always insert them. ``stale`` as in :func:`apply_changes`.

    Only the key, start and tracked columns of current versions take part in the join.
    """
    current = dimension.where(F.col(validity.current)).select(key, validity.start, *tracked)
    changes = broadcast_if_small(updates, broadcast_bytes)
    key_type = updates.schema[key].dataType
    return (
        current.alias("d")
        .join(changes.alias("u"), same_key([key], "d", "u") & differs(tracked, "d", "u"))
        .where(~_stale("d", "u", key, validity, stale))
        .select("u.*")
        .distinct()
        .withColumn(MERGE_KEY, F.lit(None).cast(key_type))
    )


def _stale(dimension: str, updates: str, key: str, validity: Validity, stale: str) -> Column:
    """The update starts before the version that it would close; refused where it happens."""
    if stale not in ("refuse", "skip"):
        raise ValueError(f"stale updates are to 'refuse' or to 'skip', not {stale!r}")
    before = F.col(f"{updates}.{quoted(validity.start)}") < F.col(f"{dimension}.{quoted(validity.start)}")
    before = F.coalesce(before, F.lit(False))
    if stale == "skip":
        return before
    told = F.concat(F.lit("stale update of key "), F.col(f"{updates}.{quoted(key)}").cast("string"))
    return F.when(before, F.raise_error(told).cast("boolean")).otherwise(False)


def _one_update_per_key(updates: DataFrame, key: str) -> ChangeSetSize:
    """Measure the updates; two for one key are an error, known key or not."""
    size = measure_change_set(updates, [key])
    if size.copies > 1:
        raise AmbiguousMergeError(f"several updates have the same {key}")
    return size


def stage_all(updates: DataFrame, key: str) -> DataFrame:
    """Every update under its own key: closes the current version or opens the first one."""
    return updates.withColumn(MERGE_KEY, F.col(key))


def stage_unopened(
    updates: DataFrame, dimension: DataFrame, key: str, current: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Updates for keys without a current version, unknown or closed, with a null merge key."""
    opened = dimension.where(F.col(current))
    unopened = anti_join(updates, opened, key, broadcast_bytes)
    return unopened.withColumn(MERGE_KEY, F.lit(None).cast(updates.schema[key].dataType))


def stage_closings(
    changes: DataFrame, dimension: DataFrame, key: str, end: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Change rows that carry an end date and whose key the dimension knows, once each."""
    ended = changes.where(F.col(end).isNotNull())
    known = semi_join(ended, dimension, key, broadcast_bytes).distinct()
    return known.withColumn(MERGE_KEY, F.col(key))


def stage_openings(changes: DataFrame, key: str, current: str) -> DataFrame:
    """Change rows that are current, with a null merge key."""
    key_type = changes.schema[key].dataType
    return changes.where(F.col(current)).distinct().withColumn(MERGE_KEY, F.lit(None).cast(key_type))


def matching_versions(dimension: DataFrame, incoming: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All versions in the dimension whose key is among the incoming ones."""
    if is_small(incoming.select(key), broadcast_bytes):
        return dimension.join(F.broadcast(incoming.select(key)), key, "left_semi")
    return join_members(dimension, incoming, [(key, key)], "left_semi", small=False)


def merge_changes(
    dimension: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    validity: Validity = DEFAULT,
    with_action: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    stale: str = "refuse",
) -> DataFrame:
    """Stage and merge: a changed current version is closed on the update's start date and a new
    current version is inserted; keys without a current version, unknown or closed, get one.

    Finding the changed rows costs a scan of the dimension's current keys and tracked columns;
    :func:`apply_changes` does without.
    """
    updates = materialize(updates, "updates")
    _one_update_per_key(updates, key)
    opened = dimension.where(F.col(validity.current))
    staged = (
        stage_changed(updates, dimension, key, tracked, validity, broadcast_bytes, stale)
        .unionByName(stage_all(semi_join(updates, opened, key, broadcast_bytes), key))
        .unionByName(stage_unopened(updates, dimension, key, validity.current, broadcast_bytes))
    )
    opened = {c: F.col(f"s.{quoted(c)}") for c in updates.columns if c in dimension.columns}
    opened[validity.current] = F.lit(True)
    opened[validity.end] = F.lit(None)
    return merge(
        dimension,
        staged,
        [(key, MERGE_KEY)],
        matched=[
            WhenMatched(
                {validity.current: F.lit(False), validity.end: F.col(f"s.{quoted(validity.start)}")},
                F.col(f"t.{quoted(validity.current)}")
                & differs(tracked, "t", "s")
                & ~_stale("t", "s", key, validity, stale),
            )
        ],
        not_matched=[WhenNotMatched(opened)],
        with_action=with_action,
        broadcast_bytes=broadcast_bytes,
    )


def apply_changes(
    dimension: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    validity: Validity = DEFAULT,
    materialize_updates: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    stale: str = "refuse",
) -> DataFrame:
    """The result of :func:`merge_changes` with fewer joins.

    Each dimension row meets its update once; a changed current version leaves as two rows, the
    closed one and its successor. Two updates for one key are an error. An update that starts
    before the version it would close is ``stale``: "refuse" makes the result fail when it is computed,
    "skip" leaves the version as it is.
    """
    if materialize_updates:
        updates = materialize(updates, "updates")
    size = _one_update_per_key(updates, key)
    changes = F.broadcast(updates) if size.within(broadcast_bytes) else updates
    joined = dimension.alias("d").join(changes.alias("u"), same_key([key], "d", "u"), "left")
    hit = (
        F.col(f"u.{quoted(key)}").isNotNull()
        & F.coalesce(F.col(f"d.{quoted(validity.current)}"), F.lit(False))
        & differs(tracked, "d", "u")
    )

    columns = {"d": dimension.columns, "u": updates.columns}

    def version(side: str, values: dict[str, Column]) -> Column:
        """A row of the dimension out of one side of the join, with some values replaced."""
        fields = []
        for field in dimension.schema.fields:
            own = F.col(f"{side}.{quoted(field.name)}") if field.name in columns[side] else F.lit(None)
            fields.append(values.get(field.name, own).cast(field.dataType).alias(field.name))
        return F.struct(*fields)

    opened = {validity.current: F.lit(True), validity.end: F.lit(None)}
    kept = version("d", {})
    closed = version("d", {validity.current: F.lit(False), validity.end: F.col(f"u.{quoted(validity.start)}")})
    hit = hit & F.when(hit, ~_stale("d", "u", key, validity, stale)).otherwise(False)
    versions = F.when(hit, F.array(closed, version("u", opened))).otherwise(F.array(kept))
    carried = joined.select(F.inline(versions))

    small = size.within(broadcast_bytes)
    open_keys = dimension.where(F.col(validity.current))
    first = join_members(updates, open_keys, [(key, key)], "left_anti", small).alias("u")
    return carried.unionByName(first.select(version("u", opened).alias("v")).select("v.*"))
