"""Bronze to silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from assay.operators import (
    align,
    cast_orders,
    dedup,
    drop_missing_critical,
    positive_measures,
    typed_orders,
    with_total_amount,
)
from assay.schemas import BRONZE, ORDER_KEY, SILVER


def valid_orders(bronze: DataFrame, *, reject_non_finite: bool = False) -> DataFrame:
    """Typed orders that pass the row rules, duplicates included: no shuffle."""
    return (
        align(bronze, BRONZE, enforce_types=False)
        .transform(cast_orders)
        .transform(drop_missing_critical)
        .transform(positive_measures, reject_non_finite=reject_non_finite)
    )


def silver_orders(
    bronze: DataFrame,
    *,
    survivor_order: Sequence[str | Column] = (),
    reject_non_finite: bool = False,
) -> DataFrame:
    """Valid orders, one row per order id.

    The rules come before the choice, so a bad copy never shadows a good one; the amount comes after
    it, so it is not shuffled.
    """
    return (
        valid_orders(bronze, reject_non_finite=reject_non_finite)
        .transform(dedup, ORDER_KEY, survivor_order)
        .transform(with_total_amount)
        .select(*SILVER.names)
    )


def silver_orders_basic(bronze: DataFrame) -> DataFrame:
    """Typed orders with all critical fields: no positivity rule, no choice among duplicates.

    Further source columns pass through.
    """
    return bronze.transform(typed_orders).transform(drop_missing_critical)
