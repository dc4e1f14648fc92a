from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from frames import bronze, silver
from pyspark.sql import functions as F

from assay.plans import (
    WRITTEN_ROWS,
    StageFailed,
    bronze_to_silver,
    bronze_to_silver_basic,
    gold_report,
    run_medallion,
    silver_inspect,
    silver_to_gold,
    silver_to_gold_basic,
)
from assay.schemas import BRONZE, GOLD, GOLD_BASIC, SILVER, Layout
from assay.sinks import SKIPPED_EMPTY, WRITTEN
from assay.sources import generate_orders, layer_folders, read_layer


def test_layout():
    layout = Layout("s3a://place/lake/")
    assert layout.bronze == "s3a://place/lake/bronze/orders"
    assert layout.silver == "s3a://place/lake/silver/silver_orders"
    assert layout.gold == "s3a://place/lake/gold/gold_orders"


def test_runs_from_ingest_to_gold(spark, tmp_path):
    layout = Layout(str(tmp_path))
    spark.sql(f"CREATE DATABASE lake LOCATION '{tmp_path / 'db'}'")
    try:
        for number, day in enumerate((1, 2)):
            import datetime as dt

            orders = generate_orders(
                spark, 100, as_of_date=dt.date(2024, 1, day), start_id=1 + 60 * number
            )
            results = run_medallion(
                spark,
                orders,
                layout,
                silver_partition="country",
                gold_partition="order_date",
                database="lake",
                exact_cents=True,
                metrics=True,
            )
        assert [r.stage for r in results] == ["ingest", "bronze_to_silver", "silver_to_gold"]
        assert {r.write.status for r in results} == {WRITTEN}
        # Ids 61 to 100 came twice, the earlier day survives.
        assert results[1].metrics == {"raw_rows": 200, "clean_rows": 160, "removed_rows": 40}
        kept = read_layer(spark, layout.silver, SILVER)
        assert kept.filter("order_date = '2024-01-01'").count() == 100
        gold = read_layer(spark, layout.gold, GOLD)
        assert results[2].metrics["silver_rows"] == 160
        assert results[2].metrics["gold_clean_rows"] == results[2].metrics["gold_rows"] == gold.count()
        assert spark.table("lake.silver_orders").count() == 160
        total = spark.sql("SELECT sum(total_quantity) FROM lake.gold_orders").first()[0]
        assert total == kept.agg(F.sum("quantity")).first()[0]
        (folder,) = layer_folders(spark, layout.gold)
        assert (Path(folder) / "order_date=2024-01-02").is_dir()
    finally:
        spark.sql("DROP DATABASE lake CASCADE")


def test_a_first_batch_without_a_valid_row_is_skipped_to_the_end(spark, tmp_path):
    layout = Layout(str(tmp_path))
    bad = bronze(spark, {"order_date": "never"})
    results = run_medallion(spark, bad, layout, metrics=True)
    assert [r.write.status for r in results] == [WRITTEN, SKIPPED_EMPTY, SKIPPED_EMPTY]
    assert results[1].metrics == {"raw_rows": 1, "clean_rows": 0, "removed_rows": 1}
    results = run_medallion(spark, bronze(spark, {}), layout)
    assert {r.write.status for r in results} == {WRITTEN}


def test_a_silver_that_is_gone_fails_the_run(spark, tmp_path):
    layout = Layout(str(tmp_path))
    run_medallion(spark, bronze(spark, {}), layout)
    shutil.rmtree(layout.silver)
    shutil.rmtree(layout.bronze)
    with pytest.raises(StageFailed, match="silver_to_gold"):
        run_medallion(spark, bronze(spark, {"order_date": "never"}), layout)
    with pytest.raises(StageFailed, match="silver_to_gold"):
        run_medallion(spark, bronze(spark, {}), layout, silver_source=str(tmp_path / "elsewhere"))


def test_a_failure_names_its_stage_and_stops(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    with pytest.raises(StageFailed, match="bronze_to_silver") as failure:
        run_medallion(spark, bronze(spark, {}), layout, bronze_source="no_such_table")
    assert failure.value.stage == "bronze_to_silver" and failure.value.__cause__ is not None

    (tmp_path / "other").write_text("a file where a folder should be")
    with pytest.raises(StageFailed, match="ingest"):
        run_medallion(spark, bronze(spark, {}), Layout(str(tmp_path / "other")))


def test_old_flat_files_stay_in_silver(spark, tmp_path):
    layout = Layout(str(tmp_path))
    folder = Path(layout.bronze)
    folder.mkdir(parents=True)
    lines = [f"old{i},2024-01-05,101,US,Widget A,3,9.99" for i in range(50)]
    (folder / "orders_lambda_1.csv").write_text("\n".join([",".join(BRONZE.names), *lines]) + "\n")
    new = bronze(spark, *[{"order_id": f"new{i}"} for i in range(5)])
    results = run_medallion(spark, new, layout, metrics=True)
    assert results[1].metrics == {"raw_rows": 55, "clean_rows": 55, "removed_rows": 0}
    ids = {r["order_id"] for r in read_layer(spark, layout.silver, SILVER).collect()}
    assert {f"old{i}" for i in range(50)} < ids


def test_line_breaks_go_through_the_run(spark, tmp_path):
    layout = Layout(str(tmp_path))
    rows = bronze(spark, {"order_id": "1", "product": "Widget\nA"}, {"order_id": "2"})
    with pytest.raises(StageFailed, match="ingest"):
        run_medallion(spark, rows, layout)
    results = run_medallion(spark, rows, layout, multi_line=True, metrics=True)
    assert results[1].metrics == {"raw_rows": 2, "clean_rows": 2, "removed_rows": 0}


def test_jobs_by_name_and_by_path(spark, tmp_path):
    layout = Layout(str(tmp_path))
    bronze(spark, {}, {"order_id": "2"}).createOrReplaceTempView("orders_view")
    bronze_to_silver("orders_view", layout.silver)
    read_layer(spark, layout.silver, SILVER).createOrReplaceTempView("silver_view")
    for source in ("silver_view", layout.silver):
        silver_to_gold(source, layout.gold)
        assert read_layer(spark, layout.gold, GOLD).first()["total_quantity"] > 0
    results = run_medallion(
        spark, bronze(spark, {}), layout, bronze_source="orders_view", silver_source="silver_view"
    )
    assert {r.write.status for r in results} == {WRITTEN}


def test_counts_of_what_was_written_alone(spark, tmp_path):
    source = bronze(spark, {}, {"quantity": "0"})
    result = bronze_to_silver(source, str(tmp_path / "s"), metrics=WRITTEN_ROWS)
    assert result.metrics == {"clean_rows": 1}


def test_an_empty_batch_leaves_the_old_layers(spark, tmp_path):
    target = str(tmp_path / "silver")
    assert bronze_to_silver(bronze(spark, {}), target).write.status == WRITTEN
    result = bronze_to_silver(bronze(spark, {"quantity": "0"}), target, metrics=True)
    assert result.write.status == SKIPPED_EMPTY
    assert result.metrics == {"raw_rows": 1, "clean_rows": 0, "removed_rows": 1}
    assert read_layer(spark, target, SILVER).count() == 1


@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("partition_by", [None, "country"])
def test_silver_counts_are_of_this_run(spark, tmp_path, mode, partition_by):
    target = str(tmp_path / "silver")
    options = {"partition_by": partition_by, "partition_overwrite": mode, "metrics": True}
    old = bronze(spark, {"country": "CA"}, {"order_id": "2"}, {"order_id": "3"})
    assert bronze_to_silver(old, target, **options).metrics["clean_rows"] == 3
    new = bronze(spark, {"order_id": "4"}, {"order_id": "4"}, {"order_id": "5", "quantity": "0"})
    result = bronze_to_silver(new, target, **options)
    assert result.metrics == {"raw_rows": 3, "clean_rows": 1, "removed_rows": 2}
    kept_old_country = mode == "dynamic" and partition_by is not None
    assert read_layer(spark, target, SILVER).count() == (2 if kept_old_country else 1)


def test_survivor_order_of_the_job(spark, tmp_path):
    target = str(tmp_path / "silver")
    source = bronze(spark, {"quantity": "1"}, {"quantity": "8"})
    bronze_to_silver(source, target, survivor_order=[F.col("quantity").desc()])
    assert read_layer(spark, target, SILVER).first()["quantity"] == 8


@pytest.mark.parametrize("metrics", [False, True])
def test_gold_job(spark, tmp_path, metrics):
    target = str(tmp_path / "gold")
    df = silver(spark, {}, {"country": None}, {"country": "CA", "quantity": -1})
    result = silver_to_gold(df, target, partition_by="country", metrics=metrics)
    assert result.write.partition_by == ("country",)
    assert [tuple(r)[1:] for r in read_layer(spark, target, GOLD).collect()] == [
        ("US", "Widget A", 1, 9.99, 9.99)
    ]
    counts = {"silver_rows": 3, "gold_rows": 3, "gold_clean_rows": 1}
    assert result.metrics == (counts if metrics else {})
    skipped = silver_to_gold(df.filter("quantity < 0"), target, metrics=metrics)
    assert skipped.write.status == SKIPPED_EMPTY
    assert read_layer(spark, target, GOLD).count() == 1


def test_nothing_is_left_behind(spark, tmp_path):
    spark.catalog.clearCache()
    silver_to_gold(silver(spark, {}), str(tmp_path / "gold"), metrics=True)
    with pytest.raises(Exception):
        bad = silver(spark, {}).withColumn("quantity", F.raise_error(F.lit("no")).cast("int"))
        silver_to_gold(bad, str(tmp_path / "g"), metrics=True)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    assert [p.name for p in tmp_path.iterdir()] == ["gold"]


def test_basic_jobs(spark, tmp_path):
    source = bronze(spark, {}, {}, {"quantity": "-1"}, {"order_id": None})
    for _ in range(2):
        bronze_to_silver_basic(source, str(tmp_path / "s"))
    df = read_layer(spark, str(tmp_path / "s"), SILVER)
    assert df.count() == 6
    silver_to_gold_basic(df, str(tmp_path / "g"), exact_cents=True)
    row = read_layer(spark, str(tmp_path / "g"), GOLD_BASIC).first()
    assert (row["total_quantity"], row["total_revenue"]) == (2, 19.98)
    silver_to_gold_basic(df.filter("false"), str(tmp_path / "g"))
    assert read_layer(spark, str(tmp_path / "g"), GOLD_BASIC).count() == 0


def test_reports(spark):
    df = silver(spark, *[{"order_id": f"{i:03}"} for i in range(30, 0, -1)])
    assert [r["order_id"] for r in silver_inspect(df).collect()] == [f"{i:03}" for i in range(1, 11)]
    assert silver_inspect(df, 3).count() == 3
    gold = spark.createDataFrame(
        [(None, "US", "B", 1, 1.0, 1.0), (None, "US", "A", 2, 2.0, 1.0), (None, "CA", "C", 3, 3.0, 1.0)], GOLD
    )
    report = gold_report(gold)
    assert report.columns == ["order_date", "country", "product", "total_quantity", "total_revenue"]
    assert [r["product"] for r in report.collect()] == ["C", "A", "B"]
