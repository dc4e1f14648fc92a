"""Small frames for tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from assay.schemas import BRONZE, SILVER

GOOD = {
    "order_id": "1",
    "order_date": "2024-01-05",
    "customer_id": "101",
    "country": "US",
    "product": "Widget A",
    "quantity": "1",
    "unit_price": "9.99",
}


def bronze(spark: SparkSession, *changes: dict) -> DataFrame:
    """One good order per argument, with the given fields changed."""
    rows = [{**GOOD, **change} for change in changes]
    return spark.createDataFrame([tuple(r[n] for n in BRONZE.names) for r in rows], BRONZE)


def silver(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = []
    for number, change in enumerate(changes):
        row = {
            "order_id": str(number),
            "order_date": dt.date(2024, 1, 5),
            "customer_id": "101",
            "country": "US",
            "product": "Widget A",
            "quantity": 1,
            "unit_price": 9.99,
            **change,
        }
        if "total_amount" not in row:
            known = row["quantity"] is not None and row["unit_price"] is not None
            row["total_amount"] = row["quantity"] * row["unit_price"] if known else None
        rows.append(tuple(row[n] for n in SILVER.names))
    return spark.createDataFrame(rows, SILVER)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
