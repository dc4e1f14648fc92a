"""Queries that read their built input more than once work it out one time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from assay.schemas import BRONZE
from assay_checks import registry


@pytest.mark.parametrize(
    "query, found",
    [("silver_publish_recovery", 20), ("silver_incremental", 12), ("partition_null_heavy", 24)],
)
def test_rows_are_built_once(spark, monkeypatch, query, found):
    orders = [
        (f"{order}-{line}", "2024-01-01", str(order), "CHINA", "TIN", "2", "1.50")
        for order in range(4)
        for line in (0, 1, 2)
    ]
    built = spark.sparkContext.accumulator(0)

    def counted(text):
        built.add(1)
        return text

    rows = spark.createDataFrame(orders, BRONZE)
    number = F.udf(counted, "string").asNondeterministic()
    monkeypatch.setattr(registry, "star_bronze", lambda *_: rows.withColumn("order_id", number("order_id")))
    assert registry.QUERIES[query](spark, "").count() == found
    assert built.value == len(orders)
