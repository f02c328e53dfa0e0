"""Type 2 changes at any place of a history: several updates of a key in one change set, and late ones.

An update says that from its start on the key has its values. If a version holds that moment, it ends there and the
update's version takes the rest of its time, up to the next change; if none does (before the first version, in a gap,
after the last one is closed), the update's version lasts until the next one starts. Later versions stay as they are. Periods are half
open, so they never overlap. An update that repeats the values in force changes nothing. One that starts with a
version leaves it an empty period, as a correction that can still be seen.

All rests on one narrow pass, :func:`timeline`, over the versions of the updated keys and the updates in order of time:
key, period and tracked columns. From it the same rows come as closings and openings, either for one pass over the
dimension (:func:`apply_history`) or staged for a merge (:func:`merge_history`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .merge import AmbiguousMergeError, WhenMatched, WhenNotMatched, merge
from .names import private, quoted
from .scd2 import DEFAULT, Validity, matching_versions
from .sizing import BROADCAST_BYTES, broadcast_if_small, measure_change_set


def timeline(
    dimension: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    validity: Validity = DEFAULT,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows (key, start, old_end, new_end, update): all versions of the updated keys, with a null ``update``, and the updates that
    change something, as structs. Updates without a key are left out; one without a start is an error."""
    moment = lambda c: F.when(F.col(quoted(c)).isNull(), F.raise_error(F.lit("an update has no start"))).otherwise(F.col(quoted(c)))
    known = updates.where(F.col(quoted(key)).isNotNull())
    versions = matching_versions(dimension, known, key, broadcast_bytes)
    values = F.struct(*(F.col(quoted(c)).cast(dimension.schema[c].dataType).alias(f"v{i}") for i, c in enumerate(tracked)))
    kinds = {c: dimension.schema[c].dataType for c in (key, validity.start, validity.end)}
    row = F.struct(*map(quoted, updates.columns))
    events = versions.select(
        F.col(quoted(key)).alias("key"), F.col(quoted(validity.start)).alias("start"), F.col(quoted(validity.end)).alias("old_end"),
        values.alias("values"), F.lit(None).cast(updates.select(row.alias("r")).schema["r"].dataType).alias("update"),
    ).unionByName(
        known.select(
            F.col(quoted(key)).cast(kinds[key]).alias("key"), moment(validity.start).cast(kinds[validity.start]).alias("start"),
            F.lit(None).cast(kinds[validity.end]).alias("old_end"), values.alias("values"), row.alias("update"),
        )
    )

    order = Window.partitionBy("key").orderBy("start", F.col("update").isNotNull())
    is_update = F.col("update").isNotNull()
    holder = F.last(F.when(~is_update, F.struct("old_end")), ignorenulls=True).over(order)
    before = F.lag(F.struct("start", "values", is_update.alias("is_update"))).over(order)
    seen = events.withColumn("holder", holder).withColumn("before", before)

    ends = F.col("holder.old_end")
    held = F.col("holder").isNotNull() & (ends.isNull() | (ends > F.col("start")))
    after_gap = F.col("before.is_update") & (F.col("holder").isNull() | (ends <= F.col("before.start")))
    in_force = F.col("before").isNotNull() & (held | F.coalesce(after_gap, F.lit(False)))
    same = in_force & F.col("before.values").eqNullSafe(F.col("values"))
    changing = seen.withColumn("held", held).where(~is_update | ~same)

    following = F.lead("start").over(order)
    next_is_update = F.lead(is_update).over(order)
    new_end = F.when(is_update, F.least(following, F.when(F.col("held"), ends))).otherwise(
        F.when(next_is_update, F.least("old_end", following)).otherwise(F.col("old_end"))
    )
    return changing.withColumn("new_end", new_end).select("key", "start", "old_end", "new_end", "update")


def _checked(updates: DataFrame, key: str, validity: Validity) -> DataFrame:
    """The updates once each, written; two that give a key different values from one moment on are an error."""
    updates = materialize(updates.distinct(), "updates")
    if measure_change_set(updates.select(quoted(key), quoted(validity.start)), [key, validity.start]).copies > 1:
        raise AmbiguousMergeError(f"several updates have the same {key} and {validity.start}")
    return updates


def _openings(events: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The updates that open versions, with ``new_end``; those without a key open one each."""
    made = events.where(F.col("update").isNotNull()).select("update.*", "new_end")
    return made.unionByName(updates.where(F.col(quoted(key)).isNull()), allowMissingColumns=True)


def _version(columns: Sequence[str], dimension: DataFrame, validity: Validity, end: Column) -> list[Column]:
    """The columns of the dimension out of an opening."""
    made = {validity.end: end, validity.current: end.isNull()}
    return [
        made.get(f.name, F.col(quoted(f.name)) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in dimension.schema.fields
    ]


def _closings(events: DataFrame) -> DataFrame:
    return events.where(F.col("update").isNull() & ~F.col("new_end").eqNullSafe(F.col("old_end")))


def apply_history(
    dimension: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    validity: Validity = DEFAULT,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The dimension after the updates, in one pass over it: each version meets the end that it got, if any."""
    updates = _checked(updates, key, validity)
    events = materialize(timeline(dimension, updates, key, tracked, validity, broadcast_bytes), "timeline")
    names = [private(dimension.columns, n) for n in ("_key", "_start", "_old_end", "_new_end")]
    closings = _closings(events).select(*(F.col(c).alias(n) for c, n in zip(("key", "start", "old_end", "new_end"), names)))
    key_, start, old_end, new_end = names
    same = (
        (F.col(quoted(key)) == F.col(key_))
        & (F.col(quoted(validity.start)) == F.col(start))
        & F.col(quoted(validity.end)).eqNullSafe(F.col(old_end))
    )
    joined = dimension.join(broadcast_if_small(closings, broadcast_bytes), same, "left")
    closed = F.col(new_end).isNotNull()
    changed = {validity.end: F.coalesce(new_end, quoted(validity.end)), validity.current: F.col(quoted(validity.current)) & ~closed}
    kept = joined.select(*(changed.get(f.name, F.col(quoted(f.name))).cast(f.dataType).alias(f.name) for f in dimension.schema.fields))
    opened = _openings(events, updates, key)
    return kept.unionByName(opened.select(_version(updates.columns, dimension, validity, F.col("new_end"))))


def merge_history(
    dimension: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    validity: Validity = DEFAULT,
    with_action: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The same by a staged merge on key and start: closings under their version's, openings under null."""
    updates = _checked(updates, key, validity)
    events = materialize(timeline(dimension, updates, key, tracked, validity, broadcast_bytes), "timeline")
    opened = _openings(events, updates, key)
    opened = opened.select(_version(updates.columns, dimension, validity, F.col("new_end")))
    merge_key, merge_start, old_end = (private(dimension.columns, n) for n in ("merge_key", "merge_start", "old_end"))
    closed = _closings(events).select(
        F.col("key").alias(merge_key), F.col("start").alias(merge_start), F.col("old_end").alias(old_end), F.col("new_end").alias(validity.end)
    )
    staged = opened.unionByName(closed, allowMissingColumns=True)
    ended = WhenMatched(
        {validity.end: F.col(f"s.{quoted(validity.end)}"), validity.current: F.lit(False)},
        F.col(f"t.{quoted(validity.end)}").eqNullSafe(F.col(f"s.{old_end}")),
    )
    values = {c: F.col(f"s.{quoted(c)}") for c in dimension.columns}
    return merge(
        dimension, staged, [(key, merge_key), (validity.start, merge_start)], [ended], [WhenNotMatched(values)],
        with_action=with_action, broadcast_bytes=broadcast_bytes,
    )
