"""Report queries over stored layers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def silver_inspect(silver: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows by order id, taken as a top-k and not as a full sort."""
    return silver.orderBy("order_id").limit(rows)


def gold_report(gold: DataFrame) -> DataFrame:
    """Quantity and revenue in order of day, country and product."""
    return gold.select(
        "order_date", "country", "product", "total_quantity", "total_revenue"
    ).orderBy("order_date", "country", "product")
