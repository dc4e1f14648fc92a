"""Quality rules of silver and gold, as predicates and as filters.

Null tests are written as ``isNotNull`` and not as ``dropna``: only the former reaches the file scan
as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.schemas import CRITICAL_FIELDS, ROLLUP_KEYS


def _all_present(names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in names])


def critical_present() -> Column:
    return _all_present(CRITICAL_FIELDS)


def measures_positive(*, reject_non_finite: bool = False) -> Column:
    """Quantity and price above zero; a null fails.

    NaN and infinite prices count as positive unless ``reject_non_finite`` is set.
    """
    rule = (F.col("quantity") > 0) & (F.col("unit_price") > 0.0)
    if reject_non_finite:
        # NaN sorts above infinity, so this one comparison turns both away.
        rule = rule & (F.col("unit_price") < F.lit(float("inf")))
    return rule


def rejection_reason(*, reject_non_finite: bool = False) -> Column:
    """The first rule that a typed order fails; null for a valid one."""
    reason = F.lit(None).cast("string")
    if reject_non_finite:
        finite = F.col("unit_price") < F.lit(float("inf"))
        reason = F.when(~finite, "unit_price not finite")
    for name in reversed(("quantity", "unit_price")):
        positive = F.coalesce(F.col(name) > 0, F.lit(False))
        reason = F.when(~positive, f"{name} not positive").otherwise(reason)
    for name in reversed(CRITICAL_FIELDS):
        reason = F.when(F.col(name).isNull(), f"missing {name}").otherwise(reason)
    return reason


def keys_present() -> Column:
    return _all_present(ROLLUP_KEYS)


def totals_non_negative() -> Column:
    return (F.col("total_quantity") >= 0) & (F.col("total_revenue") >= 0.0)


def drop_missing_critical(df: DataFrame) -> DataFrame:
    return df.filter(critical_present())


def positive_measures(df: DataFrame, *, reject_non_finite: bool = False) -> DataFrame:
    return df.filter(measures_positive(reject_non_finite=reject_non_finite))


def drop_null_keys(df: DataFrame) -> DataFrame:
    return df.filter(keys_present())


def non_negative_totals(df: DataFrame) -> DataFrame:
    return df.filter(totals_non_negative())


def gold_rules(df: DataFrame) -> DataFrame:
    """Both post-aggregation rules; Catalyst moves the key test below the aggregate."""
    return non_negative_totals(drop_null_keys(df))
