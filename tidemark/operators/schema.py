"""Schema rules for tables that grow: enforce, conform, evolve."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import try_integer
from .names import find, quoted


class SchemaMismatch(ValueError):
    """Rows do not have the schema of the table they are meant for."""


def check_types(schema: T.StructType, wanted: T.StructType) -> None:
    """Same columns with the same types, in any order."""
    problems = [f"unexpected column {n}" for n in schema.fieldNames() if find(wanted.fieldNames(), n) is None]
    for field in wanted.fields:
        name = find(schema.fieldNames(), field.name)
        if name is None:
            problems.append(f"missing column {field.name}")
        elif schema[name].dataType != field.dataType:
            problems.append(
                f"{field.name} is {schema[name].dataType.simpleString()}, not {field.dataType.simpleString()}"
            )
    if problems:
        raise SchemaMismatch("; ".join(problems))


def enforce(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """``df`` in the wanted column order, or :class:`SchemaMismatch`.

    Names and types are compared without running anything. Only if the wanted schema forbids
    nulls is the data read, in one aggregate over those columns.
    """
    check_types(df.schema, wanted)
    required = [f.name for f in wanted.fields if not f.nullable and df.schema[find(df.columns, f.name)].nullable]
    if required:
        nulls = df.agg(*(F.count(F.when(F.col(quoted(c)).isNull(), 1)).alias(c) for c in required)).first()
        found = {c: nulls[c] for c in required if nulls[c]}
        if found:
            raise SchemaMismatch(f"nulls in required columns: {found}")
    return df.select(*(F.col(quoted(f.name)).alias(f.name) for f in wanted.fields))


def conform(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """Bring rows to a schema by name, at every depth: a value that does not convert and a column or field that is
    absent become null. For lenient sources, such as an empty text in a number column."""
    columns = []
    for field in wanted.fields:
        name = find(df.columns, field.name)
        value = F.lit(None) if name is None else F.col(quoted(name))
        kind = T.NullType() if name is None else df.schema[name].dataType
        columns.append(_converted(value, kind, field.dataType).alias(field.name))
    return df.select(*columns)


def _converted(value: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    """``value`` as the wanted type; fields of structs are found by name, whatever their order."""
    if kind == wanted:
        return value
    if isinstance(kind, T.StructType) and isinstance(wanted, T.StructType):
        fields = []
        for field in wanted.fields:
            name = find(kind.fieldNames(), field.name)
            own = F.lit(None) if name is None else value.getField(name)
            fields.append(_converted(own, T.NullType() if name is None else kind[name].dataType, field.dataType).alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields)).cast(wanted)
    if isinstance(kind, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: _converted(x, kind.elementType, wanted.elementType)).cast(wanted)
    if isinstance(kind, T.MapType) and isinstance(wanted, T.MapType):
        keys = F.transform(F.map_keys(value), lambda k: _converted(k, kind.keyType, wanted.keyType))
        values = F.transform(F.map_values(value), lambda v: _converted(v, kind.valueType, wanted.valueType))
        return F.map_from_arrays(keys, values).cast(wanted)
    if isinstance(kind, T.NullType):
        return value.cast(wanted)
    if isinstance(kind, T.StringType) and isinstance(wanted, T.IntegralType):
        return try_integer(value, wanted.simpleString())
    return value.try_cast(wanted)


#: Types whose values all fit into the next one. Parquet files with the first are read as the last.
_WIDENING = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()),
    (T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType()),
)


def merged_type(base: T.DataType, added: T.DataType, path: str = "") -> T.DataType:
    """A type that holds the values of both: fields of structs at every depth, first those of ``base``; the wider one of two
    numbers or moments, if no value is lost. Anything else is a :class:`SchemaMismatch` that names the path."""
    if base == added or isinstance(added, T.NullType):
        return base
    if isinstance(base, T.NullType):
        return added
    if isinstance(base, T.StructType) and isinstance(added, T.StructType):
        fields = []
        for field in base.fields:
            other = find(added.fieldNames(), field.name)
            kind = field.dataType if other is None else merged_type(field.dataType, added[other].dataType, f"{path}{field.name}.")
            nullable = field.nullable or bool(path) and (other is None or added[other].nullable)
            fields.append(T.StructField(field.name, kind, nullable, field.metadata))
        new = [f for f in added.fields if find(base.fieldNames(), f.name) is None]
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True, f.metadata) if path else f for f in new])
    if isinstance(base, T.ArrayType) and isinstance(added, T.ArrayType):
        kind = merged_type(base.elementType, added.elementType, f"{path}element.")
        return T.ArrayType(kind, base.containsNull or added.containsNull)
    if isinstance(base, T.MapType) and isinstance(added, T.MapType):
        key = merged_type(base.keyType, added.keyType, f"{path}key.")
        return T.MapType(key, merged_type(base.valueType, added.valueType, f"{path}value."), base.valueContainsNull or added.valueContainsNull)
    if isinstance(base, T.DecimalType) and isinstance(added, T.DecimalType):
        scale = max(base.scale, added.scale)
        whole = max(base.precision - base.scale, added.precision - added.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    for chain in _WIDENING:
        if base in chain and added in chain:
            return max(base, added, key=chain.index)
    raise SchemaMismatch(f"{path.rstrip('.')} is {added.simpleString()}, not {base.simpleString()}")


def merged_schema(base: T.StructType, added: T.StructType) -> T.StructType:
    """Columns of both; what they share, also inside nested columns, is merged as by :func:`merged_type`."""
    fields = []
    for field in base.fields:
        other = find(added.fieldNames(), field.name)
        kind = field.dataType if other is None else merged_type(field.dataType, added[other].dataType, f"{field.name}.")
        fields.append(T.StructField(field.name, kind, field.nullable, field.metadata))
    return T.StructType(fields + [f for f in added.fields if find(base.fieldNames(), f.name) is None])


def union_evolving(*parts: DataFrame) -> DataFrame:
    """Union by name over the columns and fields of all parts, absent ones null, types widened."""
    whole = reduce(merged_schema, (p.schema for p in parts))
    return reduce(DataFrame.union, (conform(p, whole) for p in parts))
