"""Silver to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame

from assay.operators import gold_rules, non_negative_totals, rollup, rollup_any_amount, rollup_basic
from assay.schemas import GOLD, GOLD_BASIC


def gold_orders(silver: DataFrame, *, exact_cents: bool = False) -> DataFrame:
    """Totals per day, country and product, without null keys or negative totals."""
    return (
        rollup(silver, exact_cents=exact_cents).transform(gold_rules).select(*GOLD.names)
    )


def gold_orders_any_amount(silver: DataFrame) -> DataFrame:
    """The same totals from sums of doubles that are exact whatever the amounts."""
    return rollup_any_amount(silver).transform(gold_rules).select(*GOLD.names)


def gold_having(silver: DataFrame, *, exact_cents: bool = False) -> DataFrame:
    """The rollup under the rules on totals alone; a group whose total is null fails them."""
    return rollup(silver, exact_cents=exact_cents).transform(non_negative_totals)


def gold_orders_basic(silver: DataFrame, *, exact_cents: bool = False) -> DataFrame:
    """The rollup without a mean and without rules: groups with null keys stay."""
    return rollup_basic(silver, exact_cents=exact_cents).select(*GOLD_BASIC.names)
