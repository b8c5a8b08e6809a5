"""Text and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.schemas import PRICE


def strip(value: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def clean_text(value: Column) -> Column:
    """Stripped text, with blank turned into NULL."""
    return F.nullif(strip(value), F.lit(""))


def clean_symbol(value: Column) -> Column:
    return F.upper(clean_text(value))


def to_price(value: Column) -> Column:
    """Text to an exact decimal; NULL when it is no finite number."""
    return value.try_cast(PRICE)


def to_volume(value: Column) -> Column:
    return value.try_cast("bigint")


def percent_change(current: Column, previous: Column) -> Column:
    """Change in percent to two places; NULL when there is no non-zero previous value."""
    ratio = (current - previous) / F.nullif(previous, F.lit(0).cast(PRICE))
    return F.round(ratio * 100, 2)


def object_key(source: Column, symbol: Column, day: Column, filename: Column) -> Column:
    """Storage key of a raw payload; NULL when a part is missing or blank."""
    parts = [clean_text(source), clean_symbol(symbol), F.date_format(day, "yyyy-MM-dd"), clean_text(filename)]
    return F.concat(
        F.lit("raw/"), parts[0], F.lit("/symbol="), parts[1], F.lit("/date="), parts[2], F.lit("/"), parts[3]
    )


def object_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), clean_text(bucket), F.lit("/"), key)


def first_present(column: str, *fallbacks: Column) -> Column:
    """Fill a column's NULLs from the fallbacks, in order."""
    return F.coalesce(F.col(column), *fallbacks).alias(column)


def missing_names(required: tuple[str, ...], present: Column) -> Column:
    """Sorted array of the required names that the ``present`` array lacks."""
    return F.array_except(F.array(*[F.lit(name) for name in sorted(required)]), present)
