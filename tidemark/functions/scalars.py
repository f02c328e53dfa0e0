"""Scalar rules as native column expressions; null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower limits of the salary classes (exclusive) and their names.
LARGE_ABOVE = 20000
MEDIUM_ABOVE = 10000
LARGE = "Large"
MEDIUM = "Medium"
LOW = "Low"

# The integers whose square and cube fit into 64 bits.
SQUARE_FITS = (-3037000499, 3037000499)
CUBE_FITS = (-2097152, 2097151)

# Fixed value: what a cleaned name does not hold.
NOT_IN_A_NAME = "[^a-zA-Z0-9]"

# Fixed value: text that a cast to an integer type accepts, with the blanks it trims.
INTEGER_TEXT = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"


def square(number: Column) -> Column:
    """64-bit square; null where it does not fit. The range is tested first, since failing a
    multiplication is far slower than not doing it."""
    wide = number.cast("long")
    return F.when(wide.between(*SQUARE_FITS), wide * wide)


def cube(number: Column) -> Column:
    """64-bit cube; null where it does not fit."""
    wide = number.cast("long")
    return F.when(wide.between(*CUBE_FITS), wide * wide * wide)


def try_integer(text: Column, data_type: str = "int") -> Column:
    """Integer from text, null where it is none. Text of another form is dismissed before the cast,
    whose failure is slow; what is left can only be too large."""
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast(data_type))


def categorize(amount: Column) -> Column:
    return (
        F.when(amount > LARGE_ABOVE, LARGE)
        .when(amount > MEDIUM_ABOVE, MEDIUM)
        .when(amount.isNotNull(), LOW)
    )


def full_name(first: Column, last: Column) -> Column:
    """Both parts with a blank between; null if either is."""
    return F.concat(first, F.lit(" "), last)


def parse_date(text: Column, date_format: str) -> Column:
    """Date from text; null where the text does not follow the format."""
    return F.try_to_date(text, date_format)


def epoch_date(seconds: Column) -> Column:
    """Date of a number of seconds since 1970-01-01 UTC, whatever the session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))


def parse_epoch(text: Column, date_format: str) -> Column:
    """Seconds since 1970-01-01 00:00 of a text taken as UTC, whatever the session time zone; null
    where it does not follow the format."""
    return F.unix_seconds(F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(f"{date_format} XXX")))


def clean_name(text: Column) -> Column:
    """Everything but letters and digits becomes an underscore."""
    return F.regexp_replace(text, NOT_IN_A_NAME, "_")
