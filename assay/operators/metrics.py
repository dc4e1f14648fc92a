"""Row counts before and after the quality rules, each from one pass over its input.

The counts are ordinary aggregates. Counters kept beside the job (observed metrics, accumulators)
count again what is rerun after a lost executor, if their stage ends in a shuffle, and reach the
driver by listener events, which a busy driver may drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.align import align
from assay.operators.rollup import rollup
from assay.operators.rules import (
    critical_present,
    keys_present,
    measures_positive,
    totals_non_negative,
)
from assay.operators.typing import cast_orders
from assay.schemas import BRONZE

GROUP_ROWS = "group_rows"


def silver_metrics(bronze: DataFrame, *, reject_non_finite: bool = False) -> DataFrame:
    """One row: ``raw_rows``, ``clean_rows`` and ``removed_rows`` of bronze to silver.

    Silver has one row for each id that has a valid row, so the clean count is the number of such ids.
    Rows are counted per id first, invalid ones under null: that sums a hot id within each map task
    and is faster than a distinct count, which plans more aggregates over the same keys.
    """
    valid = critical_present() & measures_positive(reject_non_finite=reject_non_finite)
    per_id = (
        cast_orders(align(bronze, BRONZE, enforce_types=False))
        .groupBy(F.when(valid, F.col("order_id")).alias("valid_id"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    raw_rows = F.coalesce(F.sum("rows"), F.lit(0))
    clean_rows = F.count("valid_id")
    return per_id.agg(
        raw_rows.alias("raw_rows"),
        clean_rows.alias("clean_rows"),
        (raw_rows - clean_rows).alias("removed_rows"),
    )


def group_rows() -> Column:
    """The rows behind each group, an extra aggregate for :func:`rollup`."""
    return F.count(F.lit(1)).alias(GROUP_ROWS)


def count_groups(counted_rollup: DataFrame) -> DataFrame:
    """One row of gold counts from a rollup that carries :func:`group_rows`."""
    return counted_rollup.agg(
        F.coalesce(F.sum(GROUP_ROWS), F.lit(0)).cast("bigint").alias("silver_rows"),
        F.count(F.lit(1)).alias("gold_rows"),
        F.count_if(keys_present() & totals_non_negative()).alias("gold_clean_rows"),
    )


def gold_metrics(silver: DataFrame, *, exact_cents: bool = False) -> DataFrame:
    """One row: ``silver_rows``, ``gold_rows`` before and ``gold_clean_rows`` after the rules."""
    return count_groups(rollup(silver, group_rows(), exact_cents=exact_cents))
