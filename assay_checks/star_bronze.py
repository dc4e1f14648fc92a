"""Bronze orders made from the star schema, with bad values placed by key arithmetic.

Every line item becomes one bronze row. ``(l_orderkey, l_linenumber)`` is not unique in the tables, so
the order ids hold natural duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _every(key: str, step: int):
    return F.col(key) % step == 0


def star_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # Orders meet their customers first: the lines, of which there are many times more, are dealt out
    # by order and by part alone, and country names come last, from a table that every task holds.
    orders = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        table("lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    whole = F.col("l_quantity").cast("int").cast("string")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    return lines.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("order_id"),
        F.when(_every("l_orderkey", 97), F.lit(None))
        .when(_every("l_orderkey", 89), "not-a-date")
        .otherwise(month.cast("string"))
        .alias("order_date"),
        F.when(~_every("o_custkey", 83), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(F.col("c_nationkey") != 24, F.col("n_name")).alias("country"),
        F.when(~_every("l_partkey", 67), F.col("p_type")).alias("product"),
        F.when(_every("l_partkey", 71), "-3")
        .when(_every("l_partkey", 73), "0")
        .when(_every("l_partkey", 79), "abc")
        .when(_every("l_partkey", 43), F.concat(F.lit(" "), whole, F.lit(".7 ")))
        .otherwise(whole)
        .alias("quantity"),
        F.when(_every("l_suppkey", 61), "0.00")
        .when(_every("l_suppkey", 59), "")
        .when(_every("l_suppkey", 53), "-1.50")
        .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
        .alias("unit_price"),
    )
