"""Hand-made rows, one per rule, through silver and gold."""

from __future__ import annotations

import datetime as dt
import math

import pytest

from assay.plans import gold_orders, silver_orders, silver_orders_basic
from assay.schemas import BRONZE, GOLD, SILVER

ROWS = [
    ("1", "2024-01-05", "101", "US", "Widget A", "3", "9.99"),
    ("1", "2024-01-05", "101", "US", "Widget A", "5", "9.99"),
    ("2", "2024-01-05", "102", "US", "Widget A", "-1", "9.99"),
    ("2", "2024-01-06", "102", "US", "Widget A", "2", "9.99"),
    (None, "2024-01-05", "103", "US", "Widget A", "1", "9.99"),
    ("", "2024-01-05", "104", "US", "Widget A", "1", "9.99"),
    ("5", "not-a-date", "105", "US", "Widget A", "1", "9.99"),
    ("6", "2024-02-30", "106", "US", "Widget A", "1", "9.99"),
    ("7", "2024", "107", "CA", "Widget B", "1", "19.99"),
    ("8", "2024-01-05T10:11:12", "108", "CA", "Widget B", "1", "19.99"),
    ("9", "2024-01-05", None, "US", "Widget A", "1", "9.99"),
    ("10", "2024-01-05", "110", "US", "Widget A", "0", "9.99"),
    ("11", "2024-01-05", "111", "MX", "Widget C", "3.7", "10.00"),
    ("12", "2024-01-05", "112", "MX", "Widget C", "1e2", "10.00"),
    ("13", "2024-01-05", "113", "MX", "Widget C", " 5 ", "10.00"),
    ("14", "2024-01-05", "114", "MX", "Widget C", "1", "0"),
    ("15", "2024-01-05", "115", "MX", "Widget C", "1", "1,000"),
    ("16", "2024-01-05", "116", "MX", "Widget B", "1", "NaN"),
    ("17", "2024-01-05", "117", None, "Widget C", "1", "29.99"),
    ("18", "2024-01-05", "118", "US", None, "1", "29.99"),
    ("19", "01/05/2024", "119", "US", "Widget A", "1", "9.99"),
    ("20", "2024-01-05", "120", "US", "Widget A", None, "9.99"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(ROWS, BRONZE)


def test_silver_rows(edge):
    rows = {r["order_id"]: r for r in silver_orders(edge).collect()}
    assert set(rows) == {"1", "2", "", "7", "8", "11", "13", "16", "17", "18"}
    assert rows["1"]["quantity"] == 3
    assert rows["1"]["total_amount"] == 3 * 9.99
    assert rows["2"]["order_date"] == dt.date(2024, 1, 6)
    assert rows["7"]["order_date"] == dt.date(2024, 1, 1)
    assert rows["8"]["order_date"] == dt.date(2024, 1, 5)
    assert rows["11"]["quantity"] == 3
    assert rows["13"]["quantity"] == 5
    assert math.isnan(rows["16"]["total_amount"])
    assert rows["17"]["country"] is None
    assert rows["18"]["product"] is None


def test_same_rows_without_ansi(spark, edge):
    want = sorted(map(str, silver_orders(edge).collect()))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert sorted(map(str, silver_orders(edge).collect())) == want
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_silver_schema(edge):
    assert [(f.name, f.dataType) for f in silver_orders(edge).schema] == [
        (f.name, f.dataType) for f in SILVER
    ]


@pytest.mark.parametrize("exact_cents", [False, True])
def test_gold_rows(edge, exact_cents):
    gold = gold_orders(silver_orders(edge), exact_cents=exact_cents)
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in GOLD]
    rows = {tuple(r)[:3]: tuple(r)[3:] for r in gold.collect()}
    first, fifth, sixth = dt.date(2024, 1, 1), dt.date(2024, 1, 5), dt.date(2024, 1, 6)
    poisoned = rows.pop((fifth, "MX", "Widget B"))
    assert poisoned[0] == 1 and math.isnan(poisoned[1]) and math.isnan(poisoned[2])
    expected = {
        (first, "CA", "Widget B"): (1, 19.99, 19.99),
        (fifth, "CA", "Widget B"): (1, 19.99, 19.99),
        (fifth, "MX", "Widget C"): (8, 80.0, 10.0),
        (fifth, "US", "Widget A"): (4, 39.96, 9.99),
        (sixth, "US", "Widget A"): (2, 19.98, 9.99),
    }
    assert rows.keys() == expected.keys()
    for key, values in expected.items():
        assert rows[key] == (values if exact_cents else pytest.approx(values))


def test_non_finite_prices_can_be_rejected(edge):
    ids = {r["order_id"] for r in silver_orders(edge, reject_non_finite=True).collect()}
    assert "16" not in ids and len(ids) == 9


def test_basic_silver_keeps_bad_measures_and_copies(edge):
    rows = silver_orders_basic(edge).collect()
    kept = sorted(r["order_id"] for r in rows)
    gone = {None, "5", "6", "9", "19"}
    assert kept == sorted(r[0] for r in ROWS if r[0] not in gone)
    by_id = {r["order_id"]: r for r in rows}
    assert by_id["12"]["quantity"] is None and by_id["12"]["total_amount"] is None
    assert by_id["15"]["unit_price"] is None


def test_basic_silver_passes_further_columns(edge):
    from pyspark.sql import functions as F

    assert "channel" in silver_orders_basic(edge.withColumn("channel", F.lit("web"))).columns
