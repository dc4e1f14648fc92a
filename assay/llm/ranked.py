"""Places of rows in an order, however many rows a group has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.workspace import new_folder

#: ``monotonically_increasing_id`` keeps the partition above this bit, the place in it below.
_PARTITION_BIT = 33


def stored_in_order(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``rows`` as a table sorted over all its partitions, with ``part``, the partition of each row,
    and ``slot``, which rises in that order. Rows that tie in ``order`` may be in several partitions.
    """
    spark = rows.sparkSession
    path = f"{new_folder(spark)}/ordered"
    slot = F.monotonically_increasing_id()
    (
        rows.withColumn("slot", slot)
        .orderBy(*order, "slot")
        .withColumn("slot", slot)
        .withColumn("part", F.shiftright("slot", _PARTITION_BIT).cast("bigint"))
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def pieces(stored: DataFrame, group: str) -> DataFrame:
    """One row for each ``group`` and ``part`` of a table sorted by group first: ``first``, the slot of
    its first row there, ``before``, the group's rows in earlier parts, and ``total``, all its rows.

    A group has at most as many pieces as the table has partitions.
    """
    found = stored.groupBy(group, "part").agg(F.min("slot").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return found.select(
        group,
        "part",
        "first",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(whole).alias("total"),
    )
