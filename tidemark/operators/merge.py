"""Upsert of a change set into a table, as one DataFrame plan.

The target is read by a left join with the change set, which updates or keeps each of its rows;
the change rows whose key the target lacks are added by an anti join. No outer join is used:

* a change set measured as small is broadcast, so no target row is shuffled. The target keys
  needed by the anti join are then those also in the change set, hence no larger than it;
* a large change set is joined by shuffle. Adaptive execution can split a skewed target partition
  of a left join, which it cannot do for a full outer join, and the target keys of the anti join
  are made distinct before their shuffle, so a hot key arrives there once per task.

Change rows with a null key never match; they skip both joins. The change set is written once
before it is measured, matched and inserted, so that all three see the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .joins import join_members
from .names import KeySpec, as_expr, find, key_pairs, must_find, private, quoted
from .sizing import BROADCAST_BYTES, all_present, is_small, measure_change_set

ACTION = "_action"


class AmbiguousMergeError(ValueError):
    """Two change rows claim the same target row."""


@dataclass(frozen=True)
class WhenMatched:
    """Update a matched target row. ``set`` maps columns to SQL text, Columns or values; None
    takes every column of the change row."""

    set: Mapping[str, object] | None = None
    condition: str | Column | None = None


@dataclass(frozen=True)
class WhenNotMatched:
    """Insert a change row that matched nothing. ``values`` as in :class:`WhenMatched`; columns
    left out become null."""

    values: Mapping[str, object] | None = None
    condition: str | Column | None = None


def merge(
    target: DataFrame,
    source: DataFrame,
    on: KeySpec,
    matched: Sequence[WhenMatched] = (),
    not_matched: Sequence[WhenNotMatched] = (),
    *,
    aliases: tuple[str, str] = ("t", "s"),
    evolve: bool = False,
    with_action: bool = False,
    materialize_source: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Return the target after the merge.

    Clauses are tried in order and the first whose condition is true applies. Conditions and
    values see the two relations under ``aliases``. ``evolve`` lets the result gain columns that
    only the change set has. ``with_action`` adds ``_action``: kept, updated or inserted; it is refused if the
    result has a column of that name already. A change set that is a stored table already needs no
    ``materialize_source``.
    """
    pairs = key_pairs(on, target.columns, source.columns)
    if materialize_source:
        source = materialize(source, "change-set")
    source_keys = [b for _, b in pairs]
    has_key = all_present(source_keys)
    keyed = source.where(has_key)

    size = measure_change_set(source, source_keys)
    if matched and size.copies > 1:
        reject_shared_matches(target, keyed, pairs)
    small = size.within(broadcast_bytes)

    schema = _result_schema(target, source, matched, not_matched, aliases, evolve)
    if with_action and find(schema.fieldNames(), ACTION):
        raise ValueError(f"the table has a column {ACTION} of its own")
    parts = [
        _update_rows(target, keyed, pairs, matched, schema, aliases, evolve, small, with_action),
        *_insert_rows(target, source, keyed, has_key, pairs, not_matched, schema, aliases, evolve, small, with_action),
    ]
    return reduce(DataFrame.union, parts)


def merge_metrics(merged: DataFrame) -> DataFrame:
    """Rows per action of a merge made with ``with_action=True``."""
    return merged.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("num_rows"))


def observed(merged: DataFrame, counts: Observation) -> DataFrame:
    """A merge made with ``with_action=True`` whose actions are counted by the job that writes it; ``counts.get``
    then has the rows ``updated``, ``inserted`` and ``kept``. The merge is not evaluated again for them."""
    each = (F.count(F.when(F.col(ACTION) == a, 1)).alias(a) for a in ("updated", "inserted", "kept"))
    return merged.observe(counts, *each)


def reject_shared_matches(target: DataFrame, keyed: DataFrame, pairs: list[tuple[str, str]]) -> None:
    """Raise if a key that the change set repeats occurs in the target."""
    repeated = keyed.groupBy(*(quoted(b) for _, b in pairs)).count().where("count > 1").drop("count")
    hit = join_members(repeated, target, [(b, a) for a, b in pairs], "left_semi", is_small(repeated)).first()
    if hit is not None:
        raise AmbiguousMergeError(f"several change rows match the target row with key {hit.asDict()}")


def _equal(pairs: list[tuple[str, str]], left: str, right: str) -> Column:
    return reduce(
        and_, (F.col(f"{left}.{quoted(a)}") == F.col(f"{right}.{quoted(b)}") for a, b in pairs)
    )


def _result_schema(target, source, matched, not_matched, aliases, evolve) -> T.StructType:
    if not evolve:
        return target.schema
    clauses = [c.set for c in matched] + [c.values for c in not_matched]
    takes_all = any(c is None for c in clauses)
    named = {_plain(k, aliases).lower() for c in clauses if c is not None for k in c}
    added = [
        T.StructField(f.name, f.dataType, True)
        for f in source.schema.fields
        if find(target.columns, f.name) is None and (takes_all or f.name.lower() in named)
    ]
    return T.StructType(target.schema.fields + added)


def _plain(name: str, aliases: tuple[str, str]) -> str:
    """``t.price`` names the target column ``price``."""
    head, dot, tail = name.partition(".")
    return tail if dot and head.lower() in {a.lower() for a in aliases} else name


def _assignments(values, schema, source, aliases, evolve) -> dict[str, Column]:
    """Result column -> value; columns that the clause does not set are absent."""
    if values is not None:
        columns = schema.fieldNames()
        return {must_find(columns, _plain(k, aliases)): as_expr(v) for k, v in values.items()}
    found = {f: find(source.columns, f) for f in schema.fieldNames()}
    missing = [f for f, s in found.items() if s is None]
    if missing and not evolve:
        raise ValueError(f"the change set lacks the target columns {missing}")
    return {f: F.col(f"{aliases[1]}.{quoted(s)}") for f, s in found.items() if s is not None}


def _choose(present: Column, clauses: list[tuple[Column, Column]], otherwise: Column) -> Column:
    chain = None
    for condition, value in clauses:
        applies = present & condition
        chain = F.when(applies, value) if chain is None else chain.when(applies, value)
    return otherwise if chain is None else chain.otherwise(otherwise)


def _condition(condition) -> Column:
    return F.lit(True) if condition is None else as_expr(condition)


def _update_rows(target, keyed, pairs, matched, schema, aliases, evolve, small, with_action) -> DataFrame:
    t, s = aliases
    rows = target.alias(t)
    found = private(keyed.columns, "_matched_source")
    if matched:
        changes = keyed.withColumn(found, F.lit(True))
        changes = F.broadcast(changes) if small else changes
        rows = rows.join(changes.alias(s), _equal(pairs, t, s), "left")
    present = F.col(f"{s}.{found}").isNotNull() if matched else F.lit(False)
    clauses = [(_condition(c.condition), _assignments(c.set, schema, keyed, aliases, evolve)) for c in matched]

    columns = []
    for field in schema.fields:
        old = find(target.columns, field.name)
        kept = F.col(f"{t}.{quoted(old)}") if old else F.lit(None).cast(field.dataType)
        if any(field.name in sets for _, sets in clauses):
            values = [(cond, sets.get(field.name, kept).cast(field.dataType)) for cond, sets in clauses]
            kept = _choose(present, values, kept)
        columns.append(kept.alias(field.name))
    action = _choose(present, [(cond, F.lit("updated")) for cond, _ in clauses], F.lit("kept"))
    return rows.select(*columns, *([action.alias(ACTION)] if with_action else []))


def _insert_rows(
    target, source, keyed, has_key, pairs, not_matched, schema, aliases, evolve, small, with_action
) -> list[DataFrame]:
    if not not_matched:
        return []
    s = aliases[1]
    new_keys = join_members(keyed, target, [(b, a) for a, b in pairs], "left_anti", small).alias(s)
    no_key = source.where(~has_key).alias(s)

    clauses = [
        (_condition(c.condition), _assignments(c.values, schema, source, aliases, evolve))
        for c in not_matched
    ]
    wanted_row = reduce(lambda a, b: a | b, (cond for cond, _ in clauses))
    columns = [
        _choose(
            F.lit(True),
            [(cond, sets.get(f.name, F.lit(None)).cast(f.dataType)) for cond, sets in clauses],
            F.lit(None).cast(f.dataType),
        ).alias(f.name)
        for f in schema.fields
    ]
    return [
        rows.where(wanted_row).select(*columns, *([F.lit("inserted").alias(ACTION)] if with_action else []))
        for rows in (new_keys, no_key)
    ]
