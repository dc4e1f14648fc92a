"""Sums of doubles as exact arithmetic has them, rounded once."""

from __future__ import annotations

import math
import random

import pytest
from frames import silver
from pyspark.sql import functions as F

from assay.functions import exact_totals
from assay.operators import rollup_any_amount
from assay.plans import silver_to_gold
from assay.schemas import GOLD
from assay.sources import read_layer

KINDS = (
    lambda pick: pick.choice([9.99, 19.99, 0.1, -0.1]),
    lambda pick: pick.uniform(-1, 1) * 10 ** pick.randint(-300, 300),
    lambda pick: pick.choice([1e16, 1.0, -1e16, 1e-16, 2.0**53, 1.7e308]),
    lambda pick: math.ldexp(pick.randint(-(2**53), 2**53), pick.randint(-1074, -1000)),
    lambda pick: pick.choice([0.0, -0.0, 5e-324, -5e-324]),
    lambda pick: pick.uniform(-1e6, 1e6),
)


def _groups(seed: int) -> dict[int, list[float]]:
    pick = random.Random(seed)
    out = {}
    for group in range(48):
        found = [KINDS[group % 6](pick) for _ in range(pick.randint(1, 150))]
        if group % 2:  # nearly all of it cancels
            found += [-x for x in found[:-1]]
        try:
            math.fsum(found)
        except OverflowError:
            found = found[:1]
        out[group] = found
    return out


@pytest.mark.parametrize("partitions", [1, 8, 50])
def test_as_fsum_at_any_parallelism(spark, partitions):
    groups = _groups(partitions)
    rows = [(group, x) for group, found in groups.items() for x in found]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double").repartition(partitions)
    found = exact_totals(df, ["g"], {"total": F.col("x")}, F.count(F.lit(1)).alias("rows")).collect()
    assert len(found) == len(groups)
    for row in found:
        want = math.fsum(groups[row["g"]])
        assert row["total"] == want and row["total_count"] == row["rows"] == len(groups[row["g"]])


def test_nulls_infinities_and_two_amounts(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 1.0), (1, None, 2.0), (2, inf, 0.1), (2, 1.0, 0.2), (3, nan, 0.3), (4, inf, None), (4, -inf, 1e300)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    found = {r["g"]: r for r in exact_totals(df, ["g"], {"a": F.col("x"), "b": F.col("y")}).collect()}
    assert found[1]["a"] is None and found[1]["a_count"] == 0 and found[1]["b"] == 3.0
    assert found[2]["a"] == inf and found[2]["b"] == math.fsum([0.1, 0.2])
    assert math.isnan(found[3]["a"]) and math.isnan(found[4]["a"]) and found[4]["b"] == 1e300


def test_rows_are_summed_as_whole_numbers(spark):
    df = spark.createDataFrame([(1, 0.5), (1, -0.1)], "g int, x double")
    plan = exact_totals(df, ["g"], {"total": F.col("x")})._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :].lower()
    # No decimal for a row, and the logarithm of an amount is taken once.
    assert "decimal(12,0)" not in physical and physical.count("log2(") == 1


def test_gold_of_any_amount(spark, tmp_path):
    df = silver(spark, {"quantity": 3}, {"unit_price": 1e-9}, {"unit_price": 1e12}, {"country": "CA"})
    us = rollup_any_amount(df).filter("country = 'US'").first()
    assert us["total_revenue"] == math.fsum([3 * 9.99, 1e-9, 1e12])
    assert us["avg_unit_price"] == math.fsum([9.99, 1e-9, 1e12]) / 3
    silver_to_gold(df, str(tmp_path / "g"), any_amount=True)
    assert read_layer(spark, str(tmp_path / "g"), GOLD).count() == 2
    with pytest.raises(ValueError):
        silver_to_gold(df, str(tmp_path / "g"), any_amount=True, metrics=True)
