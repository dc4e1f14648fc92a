from __future__ import annotations

import math

from frames import bronze, plan_of, silver

from assay.operators import gold_metrics, silver_metrics
from assay.plans import gold_orders, silver_orders
from assay.schemas import BRONZE, SILVER


def test_silver_counts(spark):
    df = bronze(
        spark, {}, {}, {"order_id": "2"}, {"order_id": "3", "quantity": "0"}, {"order_id": None}
    )
    row = silver_metrics(df).first()
    assert tuple(row) == (5, 2, 3)
    assert row["clean_rows"] == silver_orders(df).count()


def test_silver_counts_follow_the_options(spark):
    df = bronze(spark, {}, {"order_id": "2", "unit_price": "NaN"})
    assert silver_metrics(df).first()["clean_rows"] == 2
    assert silver_metrics(df, reject_non_finite=True).first()["clean_rows"] == 1


def test_empty(spark):
    assert tuple(silver_metrics(spark.createDataFrame([], BRONZE)).first()) == (0, 0, 0)
    assert tuple(gold_metrics(spark.createDataFrame([], SILVER)).first()) == (0, 0, 0)


def test_gold_counts(spark):
    df = silver(
        spark,
        {},
        {},
        {"country": None},
        {"product": "B", "quantity": -5},
        {"product": "C", "quantity": None},
        {"product": "D", "unit_price": math.nan},
    )
    row = gold_metrics(df).first()
    assert tuple(row) == (6, 5, 2)
    assert row["gold_clean_rows"] == gold_orders(df).count()


def test_one_scan_each(spark, tmp_path):
    bronze(spark, {}).write.parquet(str(tmp_path / "b"))
    silver(spark, {}).write.parquet(str(tmp_path / "s"))
    for metrics, path in ((silver_metrics, "b"), (gold_metrics, "s")):
        plan = plan_of(metrics(spark.read.parquet(str(tmp_path / path))))
        assert plan.count("FileScan ") == 1 and "Expand" not in plan
        # One shuffle by key, one of a single row per task.
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("Exchange SinglePartition") == 1
