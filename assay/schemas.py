"""Declared schemas of the three layers, their keys, and where they live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

BRONZE = StructType(
    [
        StructField("order_id", StringType()),
        StructField("order_date", StringType()),
        StructField("customer_id", StringType()),
        StructField("country", StringType()),
        StructField("product", StringType()),
        StructField("quantity", StringType()),
        StructField("unit_price", StringType()),
    ]
)

#: Orders that silver turned away, as they came, with the first rule that they failed.
REJECTED = StructType([*BRONZE, StructField("reason", StringType())])

SILVER = StructType(
    [
        StructField("order_id", StringType()),
        StructField("order_date", DateType()),
        StructField("customer_id", StringType()),
        StructField("country", StringType()),
        StructField("product", StringType()),
        StructField("quantity", IntegerType()),
        StructField("unit_price", DoubleType()),
        StructField("total_amount", DoubleType()),
    ]
)

GOLD = StructType(
    [
        StructField("order_date", DateType()),
        StructField("country", StringType()),
        StructField("product", StringType()),
        StructField("total_quantity", LongType()),
        StructField("total_revenue", DoubleType()),
        StructField("avg_unit_price", DoubleType()),
    ]
)

GOLD_BASIC = StructType([f for f in GOLD if f.name != "avg_unit_price"])

CRITICAL_FIELDS = ("order_id", "order_date", "customer_id")
ORDER_KEY = ("order_id",)
ROLLUP_KEYS = ("order_date", "country", "product")


@dataclass(frozen=True)
class Layout:
    """All layer locations under one base folder or object-store prefix."""

    base: str

    @property
    def bronze(self) -> str:
        return f"{self.base.rstrip('/')}/bronze/orders"

    @property
    def silver(self) -> str:
        return f"{self.base.rstrip('/')}/silver/silver_orders"

    @property
    def gold(self) -> str:
        return f"{self.base.rstrip('/')}/gold/gold_orders"
