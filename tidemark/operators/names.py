"""Case-insensitive column lookup, as Spark itself resolves names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

KeySpec = str | Sequence[str | tuple[str, str]]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def find(columns: Sequence[str], name: str) -> str | None:
    """The column spelled like ``name`` up to case."""
    return next((c for c in columns if c.lower() == name.lower()), None)


def private(columns: Sequence[str], name: str) -> str:
    """``name``, or a longer one if it is among the columns (in any case): for columns that an operator needs
    between two steps and that must not meet one of the user's."""
    while find(columns, name) is not None:
        name += "_"
    return name


def must_find(columns: Sequence[str], name: str) -> str:
    found = find(columns, name)
    if found is None:
        raise ValueError(f"no column {name!r} among {list(columns)}")
    return found


def as_expr(value) -> Column:
    """SQL text becomes an expression; a Column stays one; any other value is a literal."""
    if isinstance(value, Column):
        return value
    return F.expr(value) if isinstance(value, str) else F.lit(value)


def key_pairs(on: KeySpec, left: Sequence[str], right: Sequence[str]) -> list[tuple[str, str]]:
    """Resolve ``"k"``, ``["a", "b"]`` or ``[("left", "right")]`` to actual column names."""
    names = [on] if isinstance(on, str) else list(on)
    pairs = [(n, n) if isinstance(n, str) else tuple(n) for n in names]
    return [(must_find(left, a), must_find(right, b)) for a, b in pairs]
