from assay.plans.gold import gold_having, gold_orders, gold_orders_any_amount, gold_orders_basic
from assay.plans.incremental import BUCKETED_SILVER, merge_new_runs
from assay.plans.medallion import (
    WRITTEN_ROWS,
    StageFailed,
    StageResult,
    bronze_to_silver,
    bronze_to_silver_basic,
    run_medallion,
    silver_to_gold,
    silver_to_gold_basic,
)
from assay.plans.rejected import DUPLICATE, split_orders
from assay.plans.reports import gold_report, silver_inspect
from assay.plans.silver import silver_orders, silver_orders_basic, valid_orders

__all__ = [
    "BUCKETED_SILVER",
    "DUPLICATE",
    "WRITTEN_ROWS",
    "StageFailed",
    "StageResult",
    "bronze_to_silver",
    "bronze_to_silver_basic",
    "gold_having",
    "gold_orders",
    "gold_orders_any_amount",
    "gold_orders_basic",
    "gold_report",
    "merge_new_runs",
    "run_medallion",
    "silver_inspect",
    "silver_orders",
    "silver_orders_basic",
    "silver_to_gold",
    "silver_to_gold_basic",
    "split_orders",
    "valid_orders",
]
