"""Dense row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .names import private, quoted
from .rows import canonical, holds_maps

_RANGE = "_range"
_SAMPLES_PER_RANGE = 8
MOST_RANGES = 2**14


def with_row_number(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    start: int = 0,
    rows_per_range: int = 50_000,
    most_ranges: int = MOST_RANGES,
) -> DataFrame:
    """Number all rows from ``start`` in ascending ``order``, nulls last; rows that agree on it are
    ordered by a hash of the whole row, so numbers depend on nothing but the rows.

    The rows are cut into ranges of the *whole* order key, so that many rows with the same first
    column (such as a null id) are cut further by the next ones. Three passes:

    1. a sample of the order columns gives the range bounds: eight rows per range, and at most
       ``most_ranges`` ranges, which bounds what the driver holds;
    2. the rows of each range are counted, which gives the number its first row gets;
    3. each range is sorted on its own and numbered from there.

    The bounds are plain values in the plan: a task that runs again puts its rows into the same
    ranges. If copies of one row would fill more than a range, the table is first written with a
    number per row as it is read, which parts them; which copy gets which number makes no difference.
    """
    columns = df.columns
    tie, read, range_, rows, before = (private([*columns, name], n) for n in ("_tie", "_read", _RANGE, "_rows", "_before"))
    order = [*order, tie]
    df = df.withColumn(tie, F.xxhash64(*(_hashable(f) for f in df.schema.fields)))
    bounds = _bounds(df, order, rows_per_range, most_ranges)
    if any(low == high for low, high in zip(bounds, bounds[1:])):
        df = materialize(df.withColumn(read, F.monotonically_increasing_id()), "numbering")
        order.append(read)
        bounds = _bounds(df, order, rows_per_range, most_ranges)
    numbered = _with_range(df, order, bounds, range_)
    within = Window.partitionBy(range_).orderBy(*_ascending(order))
    kept = [quoted(c) for c in columns if c.lower() != name.lower()]  # an older number of that name is replaced
    if not bounds:  # one range, whose rows all have the number that the window gives them
        numbered = numbered.withColumn(name, (F.row_number().over(within) + F.lit(start - 1)).cast("long"))
        return numbered.select(*kept, quoted(name))

    running = Window.orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(range_)
        .agg(F.count(F.lit(1)).alias(rows))
        .select(range_, F.coalesce(F.sum(rows).over(running), F.lit(0)).alias(before))
    )
    position = F.row_number().over(within) + F.col(before) + F.lit(start - 1)
    return (
        numbered.join(F.broadcast(offsets), range_)
        .withColumn(name, position.cast("long"))
        .select(*kept, quoted(name))
    )


def number_new_rows(
    df: DataFrame,
    name: str,
    order: Sequence[str],
    start: int = 0,
    rows_per_range: int = 50_000,
    most_ranges: int = MOST_RANGES,
) -> DataFrame:
    """Give the rows whose ``name`` is null the numbers after the greatest one, in ascending ``order``.

    Known numbers stay as they are, so nothing that refers to them breaks, and known rows are neither
    sorted nor shuffled: one aggregate finds their maximum, and only new rows are cut into ranges, counted and
    numbered from there as in :func:`with_row_number`. An empty table starts at ``start``. ``df`` is read twice.
    """
    number = F.col(quoted(name))
    greatest = df.agg(F.max(number)).first()[0]
    first = start if greatest is None else greatest + 1
    fresh = with_row_number(df.where(number.isNull()).drop(name), order, name, first, rows_per_range, most_ranges)
    kind = df.schema[name].dataType
    fresh = fresh.select(*(F.col(quoted(c)).cast(kind).alias(c) if c == name else quoted(c) for c in df.columns))
    return df.where(number.isNotNull()).union(fresh)


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(quoted(c)).asc_nulls_last() for c in order]


def _hashable(field: T.StructField) -> Column:
    """A column as Spark can hash it: one with maps, at any depth, as its canonical text."""
    column = F.col(quoted(field.name))
    return canonical(column, field.dataType) if holds_maps(field.dataType) else column


def _bounds(df: DataFrame, order: Sequence[str], rows_per_range: int, most_ranges: int = MOST_RANGES) -> list:
    """Order keys that cut the rows into 2^k ranges of roughly equal size; none if one is enough."""
    keys = df.select(*map(quoted, order))
    rows = keys.count()
    if rows <= rows_per_range:
        return []
    ranges = min(most_ranges, 1 << (rows // rows_per_range).bit_length())
    fraction = min(1.0, ranges * _SAMPLES_PER_RANGE / rows)
    sample = keys.sample(fraction, seed=7).orderBy(*_ascending(order)).collect()
    return [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []


def _with_range(df: DataFrame, order: Sequence[str], bounds: list, name: str = _RANGE) -> DataFrame:
    """Add how many bounds are at most the row's key, by binary search in their sorted array.

    Keys are compared as structs; since a null sorts first there, each value is preceded by
    whether it is null.
    """
    ranged = df.withColumn(name, F.lit(0))
    if not bounds:
        return ranged
    fields = [df.schema[c] for c in order]
    parts = []
    for i, field in enumerate(fields):
        parts.append(T.StructField(f"is_null_{i}", T.BooleanType(), False))
        parts.append(T.StructField(f"value_{i}", field.dataType))
    rows = [tuple(part for value in bound for part in (value is None, value)) for bound in bounds]
    schema = T.StructType([T.StructField("bounds", T.ArrayType(T.StructType(parts)))])
    # Sorted again by Spark: a moment in an hour that the clocks repeat may come back as its double.
    table = df.sparkSession.createDataFrame([(rows,)], schema).select(F.array_sort("bounds")).scalar()

    key = []
    for i, field in enumerate(fields):
        key.append(F.col(quoted(field.name)).isNull().alias(f"is_null_{i}"))
        key.append(F.col(quoted(field.name)).alias(f"value_{i}"))
    for step in (1 << i for i in reversed(range(len(bounds).bit_length()))):
        reached = F.element_at(table, F.col(name) + step) <= F.struct(*key)
        ranged = ranged.withColumn(name, F.col(name) + F.when(reached, step).otherwise(0))
    return ranged
