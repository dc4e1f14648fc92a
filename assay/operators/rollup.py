"""Totals per day, country and product.

Each rollup is one partial and one final hash aggregate around one shuffle. A group with a third of
all rows is summed inside every map task first, so it reaches its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import exact_mean, exact_sum, exact_totals
from assay.schemas import ROLLUP_KEYS


def rollup(silver: DataFrame, *extra: Column, exact_cents: bool = False) -> DataFrame:
    """Total quantity, total revenue and the unweighted mean price of the order rows.

    ``exact_cents`` sums whole cents as such and other amounts as decimals (see
    :mod:`assay.functions.money`): the result is then the same at any parallelism. ``extra`` are further aggregates to take in the same pass.
    """
    total, mean = (exact_sum, exact_mean) if exact_cents else (F.sum, F.avg)
    return silver.groupBy(*ROLLUP_KEYS).agg(
        F.sum("quantity").alias("total_quantity"),
        total(F.col("total_amount")).alias("total_revenue"),
        mean(F.col("unit_price")).alias("avg_unit_price"),
        *extra,
    )


def rollup_any_amount(silver: DataFrame) -> DataFrame:
    """The same totals with sums that are exact before they are rounded once: the same at any
    parallelism for amounts of any size, and without a tolerance (see :mod:`assay.functions.exact`).

    Two shuffles: rows are summed by group and by the powers of two that their amounts lie in, of which
    a group has a few, then these sums by group.
    """
    amounts = {"total_revenue": F.col("total_amount"), "price": F.col("unit_price")}
    totals = exact_totals(silver, ROLLUP_KEYS, amounts, F.sum("quantity").alias("total_quantity"))
    return totals.select(
        *ROLLUP_KEYS,
        "total_quantity",
        "total_revenue",
        F.when(F.col("price_count") > 0, F.col("price") / F.col("price_count")).alias("avg_unit_price"),
    )


def rollup_basic(silver: DataFrame, *, exact_cents: bool = False) -> DataFrame:
    """The same totals with revenue worked out anew from quantity and price, and no mean."""
    total = exact_sum if exact_cents else F.sum
    return silver.groupBy(*ROLLUP_KEYS).agg(
        F.sum("quantity").alias("total_quantity"),
        total(F.col("quantity") * F.col("unit_price")).alias("total_revenue"),
    )
