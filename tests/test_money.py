from __future__ import annotations

import math

import pytest
from frames import silver
from pyspark.sql import functions as F

from assay.functions import exact_mean, exact_sum
from assay.operators import gold_rules, non_negative_totals, rollup, rollup_basic


def _of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return tuple(df.agg(exact_sum(F.col("x")), exact_mean(F.col("x"))).first())


def test_sums_are_exact_and_do_not_depend_on_order(spark):
    df = spark.range(100_000).select(((F.col("id") % 9973) / 100).alias("x"))
    cents = sum(i % 9973 for i in range(100_000))
    for parts in (1, 7):
        total, mean = df.repartition(parts).agg(exact_sum(F.col("x")), exact_mean(F.col("x"))).first()
        assert total == cents / 100
        assert mean == cents / 100 / 100_000


def test_nulls_and_empty(spark):
    assert _of(spark, []) == (None, None)
    assert _of(spark, [None, None]) == (None, None)
    assert _of(spark, [0.1, None, 0.2]) == (0.3, 0.15)
    assert _of(spark, [-1.5, 1.5]) == (0.0, 0.0)


@pytest.mark.parametrize("odd", [math.nan, math.inf, -math.inf, 1e300])
def test_amounts_beyond_cents_are_not_lost(spark, odd):
    total, mean = _of(spark, [1.25, odd])
    expected = 1.25 + odd
    assert repr(total) == repr(expected) and repr(mean) == repr(expected / 2)


def test_overflow_of_the_cent_sum_falls_back(spark):
    assert _of(spark, [9e16, 9e16])[0] == 1.8e17


def test_parts_of_a_cent_are_not_rounded_away(spark):
    assert _of(spark, [0.004] * 1000) == (4.0, 0.004)
    assert _of(spark, [0.125, 0.01]) == (0.135, 0.0675)


def test_cents_beyond_bigint_stay_exact_at_any_parallelism(spark):
    values = [9e16, 0.01, 9e16, 0.02, 1e17] * 200
    df = spark.createDataFrame([(v,) for v in values], "x double")
    sums = {df.repartition(parts).agg(exact_sum(F.col("x"))).first()[0] for parts in (1, 3, 8)}
    assert sums == {200 * 28 * 10**16 + 6.0}


def test_mean_is_over_rows_not_over_quantity(spark):
    df = silver(spark, {"quantity": 9, "unit_price": 10.0}, {"quantity": 1, "unit_price": 20.0})
    row = rollup(df).first()
    assert (row["total_quantity"], row["total_revenue"], row["avg_unit_price"]) == (10, 110.0, 15.0)


def test_basic_rollup_does_not_trust_the_stored_amount(spark):
    df = silver(spark, {"quantity": 2, "unit_price": 10.0, "total_amount": 999.0})
    assert rollup(df).first()["total_revenue"] == 999.0
    assert rollup_basic(df).first()["total_revenue"] == 20.0


def test_null_key_groups_stay_until_the_rules(spark):
    df = silver(spark, {}, {"country": None}, {"product": None}, {"order_date": None})
    assert rollup(df).count() == rollup_basic(df).count() == 4
    assert gold_rules(rollup(df)).count() == 1


def test_having(spark):
    df = silver(
        spark,
        {"country": "null quantity", "quantity": None},
        {"country": "null price", "unit_price": None},
        {"country": "negative", "quantity": -2},
        {"country": "zero", "quantity": 0},
        {"country": "nan", "unit_price": math.nan},
        {"country": "minus infinity", "unit_price": -math.inf},
    )
    kept = {r["country"] for r in non_negative_totals(rollup(df)).collect()}
    assert kept == {"zero", "nan"}


def test_large_quantities_do_not_overflow(spark):
    df = silver(spark, *[{"quantity": 2_147_483_647}] * 3)
    assert rollup(df).first()["total_quantity"] == 3 * 2_147_483_647


def test_amounts_far_below_a_cent_add_up(spark):
    for amount, times in ((1e-9, 1000), (3e-7, 10), (1e-12, 5)):
        df = spark.createDataFrame([(amount,)] * times, "x double")
        assert df.agg(exact_sum(F.col("x"))).first()[0] == pytest.approx(amount * times, rel=1e-12)
    mixed = spark.createDataFrame([(0.01,), (1e-9,), (0.0,), (9.99,)], "x double")
    assert mixed.agg(exact_sum(F.col("x"))).first()[0] == pytest.approx(10.000000001, rel=1e-15)
