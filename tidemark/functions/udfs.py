"""The same rules as vectorised UDFs, for users who extend them in Python.

The native forms in :mod:`tidemark.functions.scalars` stay inside generated code and are the
default; these move whole Arrow batches to the worker. Their code travels with the query: a worker
need not have this package.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import CUBE_FITS, LARGE, LARGE_ABOVE, LOW, MEDIUM, MEDIUM_ABOVE, SQUARE_FITS


def _power_udf(exponent: int, fits: tuple[int, int]):
    @F.arrow_udf(T.LongType())
    def power(numbers: pa.Array) -> pa.Array:
        wide = numbers.cast(pa.int64())
        inside = pc.and_(pc.greater_equal(wide, fits[0]), pc.less_equal(wide, fits[1]))
        return pc.power(pc.if_else(inside, wide, None), exponent)

    return power


square_udf = _power_udf(2, SQUARE_FITS)
cube_udf = _power_udf(3, CUBE_FITS)


@F.arrow_udf(T.StringType())
def categorize_udf(amounts: pa.Array) -> pa.Array:
    large = pc.greater(amounts, LARGE_ABOVE)
    if pa.types.is_floating(amounts.type):  # NaN is above every number, as Spark orders them
        large = pc.or_(large, pc.is_nan(amounts))
    return pc.if_else(large, LARGE, pc.if_else(pc.greater(amounts, MEDIUM_ABOVE), MEDIUM, LOW))


@F.pandas_udf(T.StringType())
def concatenate_udf(first: pd.Series, last: pd.Series) -> pd.Series:
    return first.str.cat(last, sep=" ")
