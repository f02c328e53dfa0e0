"""Row hashes, tracking columns, sampling by key, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import must_find, quoted


def canonical(value: Column, kind: T.DataType) -> Column:
    """A text that no other value of the type has.

    A plain value is its text with the length before it, null a mark without a length. An array is the number of
    its elements and their texts, a struct the texts of its fields, a map the number of its entries and
    their texts in order. Bytes are written in hexadecimal.
    """
    if isinstance(kind, T.ArrayType):
        parts = F.transform(value, lambda x: canonical(x, kind.elementType))
        text = F.concat(F.lit("a"), F.size(value).cast("string"), F.lit(":"), F.array_join(parts, ""))
    elif isinstance(kind, T.StructType):
        fields = [canonical(value.getField(f.name), f.dataType) for f in kind.fields]
        text = F.when(value.isNotNull(), F.concat(F.lit("s"), *fields))
    elif isinstance(kind, T.MapType):
        entry = lambda e: F.concat(canonical(e["key"], kind.keyType), canonical(e["value"], kind.valueType))
        parts = F.array_sort(F.transform(F.map_entries(value), entry))
        text = F.concat(F.lit("m"), F.size(value).cast("string"), F.lit(":"), F.array_join(parts, ""))
    else:
        if isinstance(kind, T.BinaryType):
            plain = F.hex(value)
        else:
            plain = F.to_json(value) if isinstance(kind, T.VariantType) else value.cast("string")
        text = F.concat(F.length(plain).cast("string"), F.lit(":"), plain)
    return F.coalesce(text, F.lit("-"))


def holds_maps(kind: T.DataType) -> bool:
    """The type has maps at some depth (or variants), whose entries have no order of their own."""
    if isinstance(kind, T.StructType):
        return any(holds_maps(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return holds_maps(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def hash_of(columns: Sequence[str], schema: T.StructType | None = None) -> Column:
    """SHA-256 over the columns in the given order, of their :func:`canonical` texts: no two rows of different
    values are hashed as the same text. Without a ``schema`` all columns are taken for plain values; nested ones
    and bytes need it."""
    kinds = [T.StringType() if schema is None else schema[must_find(schema.fieldNames(), c)].dataType for c in columns]
    return F.sha2(F.concat(*(canonical(F.col(quoted(c)), k) for c, k in zip(columns, kinds))), 256)


def with_row_hash(df: DataFrame, columns: Sequence[str], name: str = "row_key") -> DataFrame:
    return df.withColumn(name, hash_of(columns, df.schema))


def changed_rows(df: DataFrame, columns: Sequence[str], name: str = "row_key") -> DataFrame:
    """Rows whose stored hash no longer fits their values, with the new hash next to it."""
    return df.withColumn(f"new_{name}", hash_of(columns, df.schema)).where(F.col(name) != F.col(f"new_{name}"))


def with_tracking(df: DataFrame) -> DataFrame:
    """Add the current flag, the open end date and the delete flag, with real types."""
    return df.withColumns(
        {
            "is_current": F.lit(True),
            "end_date": F.lit(None).cast("date"),
            "delete_flag": F.lit(False),
        }
    )


def with_editor(df: DataFrame, name: str = "edited_by") -> DataFrame:
    """Add the user of the session, as the last editor of every row."""
    return df.withColumn(name, F.current_user())


def sample_by_key(df: DataFrame, key: str, percent: int) -> DataFrame:
    """About ``percent`` of 100 rows, chosen by a hash of the key: the same rows on every run and
    after every retry."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 100
    return df.where(bucket < percent)


def sample_random(df: DataFrame, percent: int, seed: int | None = None) -> DataFrame:
    """About ``percent`` of 100 rows, chosen at random."""
    return df.where((F.rand(seed) * 100).cast("int") < percent)
