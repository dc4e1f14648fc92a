"""A third of all rows under one order id, one country and one gold group, against the same SQL."""

from __future__ import annotations

import pytest
from oracle import assert_same
from pyspark.sql import functions as F

from assay.operators import gold_metrics, silver_metrics
from assay.plans import bronze_to_silver, gold_orders, silver_orders, silver_to_gold
from assay.schemas import BRONZE, GOLD, SILVER
from assay.sources import read_layer
from assay_checks.oracles import with_stages
from assay_checks.star_bronze import star_bronze

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Bronze with one hot id and one hot country, each over a third of the rows, chosen apart."""
    path = str(tmp_path_factory.mktemp("skew") / "bronze")
    (
        star_bronze(spark, SF_DIR)
        .withColumn("spread", F.xxhash64(*BRONZE.names))
        .withColumn("order_id", F.when(F.pmod("spread", F.lit(3)) == 0, "hot").otherwise(F.col("order_id")))
        .withColumn(
            "country",
            F.when(F.pmod(F.col("spread"), F.lit(7)) < 3, "HOTLAND").otherwise(F.col("country")),
        )
        .withColumn("product", F.when(F.col("country") == "HOTLAND", "HOT").otherwise(F.col("product")))
        .select(*BRONZE.names)
        .repartition(8)
        .write.parquet(path)
    )
    return read_layer(spark, path, BRONZE), f"SELECT * FROM read_parquet('{path}/*.parquet')"


def test_hot_keys_hold_a_third(skewed):
    bronze, _ = skewed
    rows = bronze.count()
    assert bronze.filter("order_id = 'hot'").count() > 0.32 * rows
    assert bronze.filter("country = 'HOTLAND' AND product = 'HOT'").count() > 0.32 * rows


def test_silver_and_gold(skewed):
    bronze, sql = skewed
    silver = silver_orders(bronze)
    assert_same(silver, with_stages("SELECT * FROM silver", bronze=sql), SF_DIR)
    gold = gold_orders(silver, exact_cents=True)
    assert_same(gold, with_stages("SELECT * FROM gold_clean", bronze=sql), SF_DIR)


def test_written_layers_and_counts(spark, skewed, tmp_path):
    bronze, sql = skewed
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    done = bronze_to_silver(bronze, silver_path, partition_by="country", metrics=True)
    silver = read_layer(spark, silver_path, SILVER)
    rows = assert_same(silver, with_stages("SELECT * FROM silver", bronze=sql), SF_DIR)
    assert done.metrics["clean_rows"] == rows
    assert done.metrics == silver_metrics(bronze).first().asDict()

    made = silver_to_gold(
        silver, gold_path, partition_by="order_date", exact_cents=True, metrics=True
    )
    gold = read_layer(spark, gold_path, GOLD)
    assert_same(gold, with_stages("SELECT * FROM gold_clean", bronze=sql), SF_DIR)
    assert made.metrics == gold_metrics(silver).first().asDict()
