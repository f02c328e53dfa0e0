"""Upsert into a partitioned catalog table that rewrites only the partitions it touches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from ..session import materialize
from .joins import common_type
from .merge import ACTION, WhenMatched, WhenNotMatched, merge, observed
from .names import KeySpec, key_pairs, quoted
from .sizing import BROADCAST_BYTES, all_present, broadcast_if_small
from .writes import in_partitions, partition_columns, replace_partitions, replace_table


def touched_partitions(target: DataFrame, source: DataFrame, on: KeySpec, partitions: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES) -> list[Row]:
    """The partitions that hold a row whose key is in the change set. Of the table only keys are read."""
    pairs = key_pairs(on, target.columns, source.columns)
    kinds = [common_type(target, a, source, b) for a, b in pairs]
    keys = source.where(all_present([b for _, b in pairs]))
    keys = keys.select(*(F.col(quoted(b)).cast(k).alias(f"k{i}") for i, ((_, b), k) in enumerate(zip(pairs, kinds)))).distinct()
    same = reduce(and_, (F.col(f"t.{quoted(a)}").cast(k) == F.col(f"s.k{i}") for i, ((a, _), k) in enumerate(zip(pairs, kinds))))
    held = target.alias("t").join(broadcast_if_small(keys, broadcast_bytes).alias("s"), same, "left_semi")
    return held.select(*map(quoted, partitions)).distinct().collect()  # a row per partition


def merge_table(
    source: DataFrame,
    table: str,
    on: KeySpec,
    matched: Sequence[WhenMatched] = (),
    not_matched: Sequence[WhenNotMatched] = (),
    *,
    aliases: tuple[str, str] = ("t", "s"),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> dict[str, int]:
    """Merge a change set into a catalog table in place; clauses as in :func:`tidemark.operators.merge.merge`.

    Rows can change only in partitions that hold a matched key, so only these are read whole, merged and
    staged. Inserted rows, and updated ones that move, may belong to further partitions; the old rows of those are
    added, so that one dynamic overwrite replaces all. Other partitions keep their files. A touched partition that loses
    all its rows is dropped. Returns how many rows were updated, inserted and kept beside them in rewritten
    partitions, counted while the result was staged. A table without partitions is replaced whole.
    """
    spark = source.sparkSession
    target = spark.table(table)
    partitions = partition_columns(spark, table)
    source = materialize(source, "change-set")
    touched = touched_partitions(target, source, on, partitions, broadcast_bytes) if partitions else []
    held = in_partitions(target, partitions, touched) if partitions else target
    merged = merge(
        held, source, on, matched, not_matched,
        aliases=aliases, with_action=True, materialize_source=False, broadcast_bytes=broadcast_bytes,
    )
    counts = Observation("merge")
    staged = materialize(observed(merged, counts), "merged").drop(ACTION)
    metrics = {"updated": 0, "inserted": 0, "kept": 0} | counts.get
    if not metrics["updated"] and not metrics["inserted"]:
        return metrics
    if not partitions:
        replace_table(staged, table)
        return metrics
    known = {tuple(r) for r in touched}
    further = [r for r in staged.select(*map(quoted, partitions)).distinct().collect() if tuple(r) not in known]
    if further:
        staged = materialize(staged.union(in_partitions(target, partitions, further)), "merged-further")
    replace_partitions(staged, table, touched)
    return metrics
