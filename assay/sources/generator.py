"""Synthetic orders, computed on the executors and repeatable from a seed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions import hash_pick
from assay.schemas import BRONZE

# The domains of generated orders.
COUNTRIES = ("US", "CA", "MX")
PRODUCTS = ("Widget A", "Widget B", "Widget C")
UNIT_PRICES = ("9.99", "19.99", "29.99")
CUSTOMER_IDS = (100, 200)
QUANTITIES = (1, 10)


def fill_orders(
    ids: DataFrame, id_column: str, *, seed: int = 42, as_of_date: dt.date | None = None
) -> DataFrame:
    """One bronze order for each row of ``ids``; every value depends on the id and the seed alone."""
    as_of_date = as_of_date or dt.datetime.now(dt.UTC).date()
    row_id = F.col(id_column)

    def choice(name: str, values: tuple[str, ...]) -> Column:
        position = hash_pick(row_id, name, seed, len(values))
        return F.element_at(F.array(*map(F.lit, values)), (position + 1).cast("int"))

    def integer(name: str, bounds: tuple[int, int]) -> Column:
        low, high = bounds
        return (F.lit(low) + hash_pick(row_id, name, seed, high - low + 1)).cast("string")

    values = {
        "order_id": row_id.cast("string"),
        "order_date": F.lit(as_of_date.isoformat()),
        "customer_id": integer("customer_id", CUSTOMER_IDS),
        "country": choice("country", COUNTRIES),
        "product": choice("product", PRODUCTS),
        "quantity": integer("quantity", QUANTITIES),
        "unit_price": choice("unit_price", UNIT_PRICES),
    }
    return ids.select(*[values[name].alias(name) for name in BRONZE.names])


def generate_orders(
    spark: SparkSession,
    count: int = 10,
    *,
    seed: int = 42,
    as_of_date: dt.date | None = None,
    start_id: int = 1,
) -> DataFrame:
    """``count`` orders numbered from ``start_id``.

    Runs that start from the same id repeat their order ids, and silver keeps one row per id: give
    each run its own ``start_id`` unless that is wanted.
    """
    ids = spark.range(start_id, start_id + count)
    return fill_orders(ids, "id", seed=seed, as_of_date=as_of_date)
