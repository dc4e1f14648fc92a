from assay.operators.align import align
from assay.operators.dedup import dedup
from assay.operators.metrics import gold_metrics, silver_metrics
from assay.operators.rollup import rollup, rollup_any_amount, rollup_basic
from assay.operators.rules import (
    critical_present,
    drop_missing_critical,
    drop_null_keys,
    gold_rules,
    measures_positive,
    non_negative_totals,
    positive_measures,
    rejection_reason,
)
from assay.operators.typing import cast_orders, typed_orders, with_total_amount

__all__ = [
    "align",
    "cast_orders",
    "critical_present",
    "dedup",
    "drop_missing_critical",
    "drop_null_keys",
    "gold_metrics",
    "gold_rules",
    "measures_positive",
    "non_negative_totals",
    "positive_measures",
    "rejection_reason",
    "rollup",
    "rollup_any_amount",
    "rollup_basic",
    "silver_metrics",
    "typed_orders",
    "with_total_amount",
]
