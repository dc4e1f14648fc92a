"""Words, folds and inputs that several operators share.

A word is a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
On the executors' Python side ``bytes.split()`` cuts at exactly these six, and ``bytes.lower()``
touches A to Z alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_BREAKS = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    blanks = F.translate(F.coalesce(text, F.lit("")), _BREAKS, " " * len(_BREAKS))
    return F.array_remove(F.split(blanks, " "), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
