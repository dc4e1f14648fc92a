"""Typed columns and derived measures of an order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions import lenient_date, lenient_double, lenient_int


def cast_orders(df: DataFrame) -> DataFrame:
    """Silver types for the seven order columns; a value that cannot be read becomes null.

    Names are resolved as Spark does, without case unless the session says so; other columns pass
    through.
    """
    quantity_type = df.select("quantity").schema[0].dataType
    return df.withColumns(
        {
            "order_id": F.col("order_id").cast("string"),
            "order_date": lenient_date(F.col("order_date")),
            "customer_id": F.col("customer_id").cast("string"),
            "country": F.col("country").cast("string"),
            "product": F.col("product").cast("string"),
            "quantity": lenient_int(F.col("quantity"), quantity_type),
            "unit_price": lenient_double(F.col("unit_price")),
        }
    )


def with_total_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("total_amount", F.col("quantity") * F.col("unit_price"))


def typed_orders(df: DataFrame) -> DataFrame:
    """Cast the order columns and add ``total_amount``."""
    return with_total_amount(cast_orders(df))
