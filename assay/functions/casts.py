"""Casts that give null for bad input, whatever ``spark.sql.ansi.enabled`` says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# "3.7", "-.5" or " 12. ": a plain decimal, padded by blanks or control characters.
_PLAIN_DECIMAL = (
    r"^[\x00-\x20\x7f]*(?<sign>[+-]?)(?<whole>[0-9]*)[.][0-9]*[\x00-\x20\x7f]*$"
)


def lenient_int(column: Column, source: DataType = StringType()) -> Column:
    """Whole part of a number as int: ``'3.7'`` is 3, ``'1e2'`` and ``'abc'`` are null.

    The regular expression runs only for text that is not already a whole number.
    """
    whole = column.try_cast("int")
    if not isinstance(source, StringType):
        return whole
    return F.coalesce(
        whole,
        F.regexp_replace(column, _PLAIN_DECIMAL, "${sign}0${whole}").try_cast("int"),
    )


def lenient_double(column: Column) -> Column:
    return column.try_cast("double")


def lenient_date(column: Column) -> Column:
    """ISO dates and timestamps, also ``yyyy`` and ``yyyy-MM``; anything else is null."""
    return column.try_cast("date")
