"""Orders that silver turns away, with their reasons."""

from __future__ import annotations

import pytest
from frames import bronze
from pyspark.sql import functions as F

from assay.operators import silver_metrics
from assay.plans import DUPLICATE, silver_orders, split_orders
from assay.schemas import BRONZE, REJECTED, SILVER
from assay.sources import read_layer


def _split(spark, tmp_path, df, **settings):
    silver, rejected = str(tmp_path / "silver"), str(tmp_path / "rejected")
    *_, counts = split_orders(df, silver, rejected, **settings)
    return read_layer(spark, silver, SILVER), read_layer(spark, rejected, REJECTED), counts


def test_each_rule_is_named_and_rows_are_as_they_came(spark, tmp_path):
    df = bronze(
        spark,
        {"order_id": "good"},
        {"order_id": "good", "customer_id": "999"},
        {"order_id": None, "order_date": "never"},
        {"order_id": "date", "order_date": "never", "quantity": "0"},
        {"order_id": "customer", "customer_id": None},
        {"order_id": "quantity", "quantity": " abc"},
        {"order_id": "price", "unit_price": "-1.50"},
        {"order_id": "both", "quantity": "-3", "unit_price": "x"},
    )
    silver, rejected, counts = _split(spark, tmp_path, df)
    found = {(r["order_id"], r["reason"]) for r in rejected.collect()}
    assert found == {
        ("good", DUPLICATE),
        (None, "missing order_id"),
        ("date", "missing order_date"),
        ("customer", "missing customer_id"),
        ("quantity", "quantity not positive"),
        ("both", "quantity not positive"),
        ("price", "unit_price not positive"),
    }
    assert rejected.filter("order_id = 'quantity'").first()["quantity"] == " abc"
    assert rejected.filter("order_id = 'good'").first()["customer_id"] == "999"
    assert [r["customer_id"] for r in silver.collect()] == ["101"]
    assert counts["raw_rows"] == 8 and counts["quantity not positive"] == 2
    assert sum(n for name, n in counts.items() if not name.endswith("_rows")) == counts["removed_rows"] == 7


def test_counts_and_silver_are_those_of_the_plain_job(spark, tmp_path):
    ids = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string"))
    df = spark.range(0, 3000, 1, 6).select(
        *[
            {
                "order_id": ids,
                "order_date": F.when(F.col("id") % 11 != 0, F.lit("2024-01-05")),
                "quantity": (F.col("id") % 7).cast("string"),
                "unit_price": F.lit("9.99"),
            }.get(name, F.concat(F.lit(name), (F.col("id") % 5).cast("string"))).alias(name)
            for name in BRONZE.names
        ]
    )
    silver, rejected, counts = _split(spark, tmp_path, df, partition_by="country")
    assert sorted(map(str, silver.collect())) == sorted(map(str, silver_orders(df).collect()))
    plain = silver_metrics(df).first().asDict()
    assert {name: counts[name] for name in plain} == plain
    back = rejected.drop("reason").unionByName(df.limit(0))
    assert back.exceptAll(df).count() == 0 and back.count() == counts["removed_rows"]


def test_equal_rows_leave_one(spark, tmp_path):
    silver, rejected, counts = _split(spark, tmp_path, bronze(spark, {}, {}, {}))
    assert silver.count() == 1 and counts[DUPLICATE] == rejected.count() == 2


@pytest.mark.parametrize("reject", [False, True])
def test_infinite_prices(spark, tmp_path, reject):
    df = bronze(spark, {"unit_price": "Infinity"}, {"order_id": "2", "unit_price": "NaN"}, {"order_id": "3"})
    silver, rejected, _ = _split(spark, tmp_path, df, reject_non_finite=reject)
    assert silver.count() == (1 if reject else 3)
    assert {r["reason"] for r in rejected.collect()} == ({"unit_price not finite"} if reject else set())


def test_nothing_rejected_and_nothing_kept(spark, tmp_path):
    _, rejected, counts = _split(spark, tmp_path, bronze(spark, {}))
    assert rejected.count() == 0 and counts["removed_rows"] == 0
    silver, rejected, counts = _split(spark, tmp_path, bronze(spark, {"quantity": "0"}))
    assert silver.count() == 1, "an empty silver leaves the old one"
    assert rejected.count() == 1 and counts["clean_rows"] == 0
