"""Physical plans: what reaches the scan, and how often data moves."""

from __future__ import annotations

import pytest
from frames import bronze, plan_of, silver

from assay.plans import gold_orders, gold_report, silver_inspect, silver_orders, silver_orders_basic
from assay.schemas import BRONZE, SILVER
from assay.sinks import write_layer
from assay.sources import read_layer


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    bronze(spark, {}).write.parquet(str(base / "bronze"))
    write_layer(silver(spark, {}, {"country": "CA"}), str(base / "silver"), partition_by="country")
    return (
        read_layer(spark, str(base / "bronze"), BRONZE),
        read_layer(spark, str(base / "silver"), SILVER),
    )


def test_silver_pushes_null_tests(stored):
    plan = plan_of(silver_orders(stored[0]))
    for name in ("order_id", "order_date", "customer_id"):
        assert f"IsNotNull({name})" in plan


def test_basic_silver_does_not_shuffle(stored):
    assert "Exchange" not in plan_of(silver_orders_basic(stored[0]))


def test_gold_is_partial_and_final_around_one_shuffle(stored):
    plan = plan_of(gold_orders(stored[1]))
    assert plan.count("Exchange ") == 1 and plan.count("HashAggregate") == 2
    assert "partial_sum" in plan and "SortAggregate" not in plan
    assert "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("exact_cents", [False, True])
def test_gold_key_rules_and_columns_reach_the_scan(stored, exact_cents):
    plan = plan_of(gold_orders(stored[1], exact_cents=exact_cents))
    scan = plan[plan.index("FileScan") :]
    assert "PartitionFilters: [isnotnull(country" in scan
    assert "PushedFilters: [IsNotNull(order_date), IsNotNull(product)]" in scan
    assert "customer_id" not in scan and "order_id" not in scan
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_country_of_gold_prunes_partitions_of_silver(stored):
    scan = plan_of(gold_orders(stored[1]).filter("country = 'CA'"))
    assert "PartitionFilters: [isnotnull(country" in scan and "= CA)]" in scan


def test_report_reads_no_price(stored):
    scan = plan_of(gold_report(gold_orders(stored[1])))
    assert "unit_price" not in scan[scan.index("FileScan") :]


def test_inspect_is_a_top_k(stored):
    assert plan_of(silver_inspect(stored[1])).startswith("TakeOrderedAndProject")


def test_no_broadcast_hint_and_no_python(stored):
    for df in (silver_orders(stored[0]), gold_orders(stored[1])):
        plan = plan_of(df)
        assert "Python" not in plan and "Broadcast" not in plan and "Cartesian" not in plan
