"""Cut a corpus into shards of near equal bytes with a k-d tree over metadata.

Each node is cut at the weighted median of its widest dimension (its range there, as a share of the
range of the whole corpus), until each leaf is one shard. The median comes from histograms: bytes
are summed by node and bucket, and only the bucket that holds the median is cut into finer ones.
Rows of one metadata value are ordered by a hash of the text, and rows of one text by a hash of the
id. The metadata that every corpus has, and the default, is read off the text: bytes, characters,
lines and bytes beyond ASCII. So rows with equal texts stay in one shard, unless their group is so
large that shards would not be near equal; then it is cut like any other range. Metadata columns can
be added as dimensions; they may part equal texts that differ in them.

A row's place follows from its own columns and the cuts, of which there is one per inner node. All
counting is done on a narrow table; the rows themselves move once, to their shard.

Defined results: a null text has no bytes, plus 1 like any other; null metadata sorts first; rows
alike in all columns stay together; with fewer rows than shards some shards are empty; an empty table
gives an empty result; columns of the input keep their names and values, ``shard`` and ``slot`` are
replaced if they are there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import broadcast_if_small
from ..session import materialize
from .text import private

BUCKETS = 1024
#: A cut may miss its median by this share of a shard where that saves a pass over the rows,
TOLERANCE = 0.001
#: and by half of this where it keeps a group of equal texts together.
GROUP_TOLERANCE = 0.04
ROWS_PER_CHUNK = 50_000

_HASH_END = 2**56


@dataclass(frozen=True)
class Cut:
    """Rows of ``node`` whose (dimension, text hash, id hash) is below (value, group, tie) stay left."""

    node: int
    right: int
    dimension: int
    value: int
    group: int
    tie: int


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def position(df: DataFrame, name: str) -> Column:
    """A metadata column as a non-negative integer in the order of its values (texts: of their first
    six bytes); null is 0."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        value = F.greatest(F.floor(F.col(name)).cast("long"), F.lit(0)) + 1
    else:
        first = F.substring(F.col(name).cast("string").cast("binary"), 1, 6)
        value = F.conv(F.rpad(F.hex(first), 12, "0"), 16, 10).cast("long") + 1
    return F.coalesce(value, F.lit(0)).cast("long")


def place_columns(df: DataFrame, ident: str, text: str, dimensions: Sequence[str] = ()) -> list[Column]:
    """What a row's place depends on: size, hashes of text and id, and its position in each dimension."""
    whole = F.coalesce(F.col(text), F.lit(""))
    group = F.shiftrightunsigned(F.xxhash64(whole), 8)
    tie = F.shiftrightunsigned(F.xxhash64(F.col(ident), whole), 8)
    chars = F.length(whole).cast("long")
    lines = chars - F.length(F.replace(whole, F.lit("\n"), F.lit("")))
    beyond_ascii = F.octet_length(whole) - chars
    axes = [byte_size(whole), chars, lines, beyond_ascii, *(position(df, d) for d in dimensions)]
    return [byte_size(F.col(text)).alias("size"), group.alias("group"), tie.alias("tie"), F.array(*axes).alias("axes")]


def _values(spark: SparkSession, names: Sequence[str], rows: Sequence[Sequence[int]]) -> DataFrame:
    """Integers of the driver as a relation: one row per node of a level of the tree."""
    cells = ", ".join(f"({', '.join(f'{v}L' for v in row)})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {cells} AS nodes({', '.join(f'`{n}`' for n in names)})")


@dataclass
class _Search:
    """The interval of one node's order that holds its median: of level 0 (dimension), 1 (text hash
    among rows of one value) or 2 (id hash among rows of one text)."""

    node: int
    right: int
    dimension: int
    goal: float
    low: int
    high: int
    level: int = 0
    value: int = 0
    group: int = 0
    before: int = 0

    def row(self) -> tuple[int, ...]:
        width = -(-(self.high - self.low + 1) // BUCKETS)
        return (self.node, self.dimension, self.level, self.value, self.group, self.low, self.high, width, self.before, math.ceil(self.goal))

    def cut(self, key: int) -> Cut:
        at = (key, 0, 0) if self.level == 0 else (self.value, key, 0) if self.level == 1 else (self.value, self.group, key)
        return Cut(self.node, self.right, self.dimension, *at)

    def narrowed(self, before: int, inside: int, least: int, most: int, tolerance: float, whole: float) -> Cut | None:
        """Go on in the bucket that holds the median, or cut at its nearer edge."""
        single = least == most
        if inside <= tolerance or single and (self.level == 2 or self.level == 1 and inside <= whole):
            return self.cut(least if 2 * (self.goal - before) <= inside else most + 1)
        self.before = before
        if not single:
            self.low, self.high = least, most
        else:
            if self.level == 0:
                self.value = least
            else:
                self.group = least
            self.level, self.low, self.high = self.level + 1, 0, _HASH_END - 1
        return None


_SEARCH = ("node", "dimension", "level", "value", "in_group", "low", "high", "width", "before", "goal")


def _medians(narrow: DataFrame, searches: list[_Search], tolerance: float, whole: float) -> list[Cut]:
    """The cuts of all nodes of a level, found together; each round reads less of the order."""
    spark, cuts = narrow.sparkSession, []
    axis = F.element_at("axes", F.col("dimension").cast("int") + 1)
    key = F.when(F.col("level") == 0, axis).when(F.col("level") == 1, F.col("group")).otherwise(F.col("tie"))
    pinned = ((F.col("level") < 1) | (axis == F.col("value"))) & ((F.col("level") < 2) | (F.col("group") == F.col("in_group")))
    running = Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    while searches:
        of = {s.node: s for s in searches}
        inside = (
            narrow.join(F.broadcast(_values(spark, _SEARCH, [s.row() for s in searches])), "node")
            .filter(pinned)
            .withColumn("key", key)
            .filter(F.col("key").between(F.col("low"), F.col("high")))
        )
        histogram = inside.groupBy("node", F.expr("(key - low) div width").alias("bucket")).agg(
            F.sum("size").alias("bytes"),
            F.min("key").alias("least"),
            F.max("key").alias("most"),
            F.max("before").alias("before"),
            F.max("goal").alias("goal"),
        )
        found = (
            histogram.withColumn("below", F.col("before") + F.coalesce(F.sum("bytes").over(running), F.lit(0)))
            .filter((F.col("below") < F.col("goal")) & (F.col("below") + F.col("bytes") >= F.col("goal")))
            .select("node", "below", "bytes", "least", "most")
            .collect()  # one row per node
        )
        searches = []
        for node, *bucket in found:
            cut = of[node].narrowed(*bucket, tolerance, whole)
            if cut:
                cuts.append(cut)
            else:
                searches.append(of[node])
    return cuts


def place(df: DataFrame, levels: Sequence[Sequence[Cut]]) -> DataFrame:
    """``df`` (with the columns of :func:`place_columns`) with its ``node`` after the given levels."""
    df = df.withColumn("node", _root())
    for cuts in levels:
        df = _descend(df, cuts)
    return df


def _root() -> Column:
    """0, taken from bits that a hash does not have: joined on a constant, rows would meet in a loop."""
    return F.shiftright("tie", 56)


def _descend(df: DataFrame, cuts: Sequence[Cut]) -> DataFrame:
    if not cuts:
        return df
    names = [f"cut_{n}" for n in ("node", "right", "dimension", "value", "group", "tie")]
    rows = [(c.node, c.right, c.dimension, c.value, c.group, c.tie) for c in cuts]
    axis = F.element_at("axes", F.col("cut_dimension").cast("int") + 1)
    key = F.struct(axis.alias("a"), F.col("group").alias("b"), F.col("tie").alias("c"))
    at = F.struct(F.col("cut_value").alias("a"), F.col("cut_group").alias("b"), F.col("cut_tie").alias("c"))
    values = F.broadcast(_values(df.sparkSession, names, rows))
    below = F.when(F.col("cut_node").isNull() | (key < at), F.col("node")).otherwise(F.col("cut_right"))
    return df.join(values, F.col("node") == F.col("cut_node"), "left").withColumn("node", below).drop(*names)


def shards_for(total_bytes: int, target_bytes: int) -> int:
    """How many leaves reach ``target_bytes``."""
    return max(1, -(-total_bytes // target_bytes))


def grow(narrow: DataFrame, shards: int) -> list[list[Cut]]:
    """The cuts of each level of the tree over ``narrow`` (the columns of :func:`place_columns`).

    A node is named by its first shard. One that holds k shards gives half of them, rounded down,
    and the same part of its bytes to its left child. Per level, one statistic per node and two
    to ten histograms; the narrow table is written with the new nodes for the next level.
    """
    nodes, levels, spans = {0: shards}, [], None
    narrow = narrow.withColumn("node", _root())
    n_axes = narrow.select(F.size("axes")).limit(1).collect()
    if not n_axes:
        return []
    axes = [F.element_at("axes", i + 1) for i in range(n_axes[0][0])]
    while any(k > 1 for k in nodes.values()):
        bounds = [f(a) for a in axes for f in (F.min, F.max)]
        stats = narrow.groupBy("node").agg(F.sum("size"), *bounds).collect()  # one row per node
        if spans is None:
            total = stats[0][1]
            spans = [max(1, stats[0][3 + 2 * i] - stats[0][2 + 2 * i]) for i in range(len(axes))]
        searches = []
        for node, size, *ends in stats:
            k = nodes[node]
            if k > 1:
                widest = max(range(len(axes)), key=lambda i: ((ends[2 * i + 1] - ends[2 * i]) / spans[i], -i))
                searches.append(
                    _Search(node, node + k // 2, widest, size * (k // 2) / k, ends[2 * widest], ends[2 * widest + 1])
                )
        leaf = total / shards
        cuts = _medians(narrow, searches, TOLERANCE * leaf, GROUP_TOLERANCE * leaf)
        levels.append(cuts)
        nodes = {n: c for node, k in nodes.items() for n, c in ((node, k // 2), (node + k // 2, k - k // 2)) if c}
        if any(k > 1 for k in nodes.values()):
            narrow = materialize(_descend(narrow, cuts), "shard-nodes")
    return levels


def with_slot(df: DataFrame, shard: str, order: Sequence[Column], tie: Column, rows: int, shards: int) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, each chunk of a shard in a task of its own."""
    chunks = max(1, -(-rows // (shards * ROWS_PER_CHUNK)))
    df = df.withColumn("slot_chunk", F.pmod(tie, F.lit(chunks)))
    running = Window.partitionBy(shard).orderBy("slot_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        df.groupBy(shard, "slot_chunk")
        .agg(F.count(F.lit(1)).alias("slot_rows"))
        .select(
            F.col(shard).alias("slot_shard"),
            F.col("slot_chunk").alias("slot_of"),
            F.coalesce(F.sum("slot_rows").over(running), F.lit(0)).alias("slot_before"),
        )
    )
    within = Window.partitionBy(shard, "slot_chunk").orderBy(*order)
    same = (F.col(shard) == F.col("slot_shard")) & (F.col("slot_chunk") == F.col("slot_of"))
    return (
        df.withColumn("slot_row", F.row_number().over(within) - 1)
        .join(broadcast_if_small(before), same)
        .withColumn("slot", (F.col("slot_row") + F.col("slot_before")).cast("long"))
        .drop("slot_chunk", "slot_row", "slot_shard", "slot_of", "slot_before")
    )


def shard(
    docs: DataFrame,
    shards: int | None = None,
    *,
    target_bytes: int = 1 << 30,
    least: int = 1,
    ident: str = "doc_id",
    text: str = "text",
    dimensions: Sequence[str] = (),
) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot``, the row's number in its shard.

    Without ``shards`` there are as many as reach ``target_bytes``, and at least ``least``. ``docs`` is read twice.
    """
    plain = docs.drop("shard", "slot")
    whole = private(plain, "shard_row")
    columns = place_columns(plain, ident, text, dimensions)
    narrow = materialize(plain.select(*columns), "shard-places")
    rows, size = narrow.agg(F.count(F.lit(1)), F.sum("size")).first()
    shards = shards or max(least, shards_for(size or 0, target_bytes))
    levels = grow(narrow, shards)
    packed = plain.select(F.struct("*").alias(whole), *columns)
    placed = place(packed, levels).withColumn("shard", F.col("node").cast("int"))
    order = [F.col(f"{whole}.`{ident}`").asc_nulls_last(), F.col("group"), F.col("tie")]
    return with_slot(placed, "shard", order, F.col("tie"), rows, shards).select(f"{whole}.*", "shard", "slot")
