from __future__ import annotations

import datetime as dt

import pytest
from frames import plan_of
from pyspark.sql import functions as F

from assay.functions import hash_pick
from assay.plans import silver_orders
from assay.schemas import BRONZE
from assay.sources import fill_orders, generate_orders

DAY = dt.date(2024, 1, 5)


def test_ten_orders_of_today_by_default(spark):
    rows = generate_orders(spark).collect()
    assert [r["order_id"] for r in rows] == [str(i) for i in range(1, 11)]
    today = dt.datetime.now(dt.UTC).date()
    assert {r["order_date"] for r in rows} <= {str(today), str(today - dt.timedelta(days=1))}


def test_domains_are_covered_evenly(spark):
    df = generate_orders(spark, 20_000, as_of_date=DAY)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in BRONZE]
    domains = {
        "customer_id": {str(i) for i in range(100, 201)},
        "country": {"US", "CA", "MX"},
        "product": {"Widget A", "Widget B", "Widget C"},
        "quantity": {str(i) for i in range(1, 11)},
        "unit_price": {"9.99", "19.99", "29.99"},
    }
    for name, values in domains.items():
        counts = {r[name]: r["count"] for r in df.groupBy(name).count().collect()}
        assert counts.keys() == values
        share = 20_000 / len(values)
        assert all(0.6 * share < count < 1.4 * share for count in counts.values()), name


def test_same_rows_at_any_partitioning(spark):
    ids = spark.range(1, 501)
    rows = [
        sorted(fill_orders(ids.repartition(n), "id", seed=7, as_of_date=DAY).collect()) for n in (1, 5)
    ]
    assert rows[0] == rows[1] == sorted(generate_orders(spark, 500, seed=7, as_of_date=DAY).collect())


def test_seed_and_start(spark):
    first = generate_orders(spark, 200, seed=1, as_of_date=DAY).collect()
    assert first != generate_orders(spark, 200, seed=2, as_of_date=DAY).collect()
    tail = generate_orders(spark, 100, seed=1, as_of_date=DAY, start_id=101).collect()
    assert first[100:] == tail


def test_only_the_key_is_read(spark):
    keys = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan_of(fill_orders(keys, "o_orderkey"))


def test_all_generated_orders_are_valid(spark):
    df = generate_orders(spark, 300, as_of_date=DAY)
    assert silver_orders(df).count() == 300
    assert silver_orders(df.union(df)).count() == 300


@pytest.mark.parametrize("size", [1, 2, 101])
def test_picks_stay_in_range(spark, size):
    low, high = (
        spark.range(1000).select(hash_pick(F.col("id"), "x", 3, size).alias("p")).agg(F.min("p"), F.max("p"))
    ).first()
    assert (low, high) == (0, size - 1)
