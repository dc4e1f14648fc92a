from __future__ import annotations

import logging
from pathlib import Path

import pytest
from frames import silver
from pyspark.sql import functions as F

from assay.operators import drop_missing_critical
from assay.schemas import SILVER
from assay.sinks import SKIPPED_EMPTY, WRITTEN, append_layer, resolve_partition, write_layer
from assay.sources import layer_folders, open_source, read_foreign_layer, read_layer


def _ids(spark, path):
    return sorted(r["order_id"] for r in read_layer(spark, path, SILVER).collect())


def _data_files(path):
    return list(Path(path).rglob("*.parquet"))


def test_partition_column_must_be_there_as_spelled(spark, caplog):
    df = silver(spark, {})
    assert resolve_partition(df, "country") == ["country"]
    with caplog.at_level(logging.WARNING):
        assert resolve_partition(df, "Country") == []
        assert resolve_partition(df, "region") == []
        assert resolve_partition(df, "") == []
    assert len(caplog.records) == 3


def test_unknown_partition_column_writes_flat(spark, tmp_path):
    target = str(tmp_path / "t")
    result = write_layer(silver(spark, {}), target, partition_by="region")
    assert (result.status, result.partition_by) == (WRITTEN, ())
    assert not list(Path(target).glob("*/*=*")) and _ids(spark, target) == ["0"]


def test_partition_values_keep_type_place_and_nulls(spark, tmp_path):
    target = str(tmp_path / "t")
    df = silver(spark, {"country": "007"}, {"country": None}, {"country": "a/b=c"}, {"country": "2024-01-05"})
    write_layer(df, target, partition_by="country")
    back = read_layer(spark, target, SILVER)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in SILVER]
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_partition_by_date(spark, tmp_path):
    target = str(tmp_path / "t")
    df = silver(spark, {}, {})
    write_layer(df, target, partition_by="order_date")
    (folder,) = layer_folders(spark, target)
    assert (Path(folder) / "order_date=2024-01-05").is_dir()
    assert sorted(read_layer(spark, target, SILVER).collect()) == sorted(df.collect())


def test_no_rows_leave_the_old_target(spark, tmp_path, caplog):
    target = str(tmp_path / "t")
    write_layer(silver(spark, {}), target)
    with caplog.at_level(logging.WARNING):
        result = write_layer(silver(spark, {}).filter("quantity > 5"), target)
    assert result.status == SKIPPED_EMPTY and caplog.records
    assert _ids(spark, target) == ["0"]


def test_no_rows_and_no_target(spark, tmp_path):
    target = tmp_path / "t"
    write_layer(silver(spark, {}).filter("false"), str(target))
    assert not target.exists()


def test_rows_are_counted_and_worked_out_once(spark, tmp_path):
    target = str(tmp_path / "t")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = silver(spark, {}, {}, {})
    result = write_layer(df.mapInArrow(count, df.schema), target, partition_by="country", rebalance=False)
    assert (result.rows, seen.value) == (3, 3)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_failed_overwrite_leaves_the_old_layer(spark, tmp_path):
    target = str(tmp_path / "t")
    write_layer(silver(spark, {}), target)
    bad = silver(spark, {}, {}).withColumn("product", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        write_layer(bad, target)
    assert _ids(spark, target) == ["0"] and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_layer_can_be_rewritten_from_itself(spark, tmp_path):
    target = str(tmp_path / "t")
    write_layer(silver(spark, {}, {}), target)
    write_layer(read_layer(spark, target, SILVER).filter("order_id = '1'"), target)
    assert _ids(spark, target) == ["1"]


def test_append_mode_is_guarded_too(spark, tmp_path):
    target = str(tmp_path / "t")
    for df in (silver(spark, {}), silver(spark, {}).filter("false"), silver(spark, {})):
        write_layer(df, target, mode="append", partition_by="country")
    assert _ids(spark, target) == ["0", "0"]


@pytest.mark.parametrize("partition_by", [None, "country"])
def test_an_empty_country_is_null_in_any_layout(spark, tmp_path, partition_by):
    target = str(tmp_path / "t")
    write_layer(silver(spark, {"country": ""}, {"country": None}), target, partition_by=partition_by)
    assert {r["country"] for r in read_layer(spark, target, SILVER).collect()} == {None}


def test_a_layer_of_another_writer(spark, tmp_path):
    target = str(tmp_path / "t")
    df = silver(spark, {"quantity": 3}).withColumn("quantity", F.col("quantity").cast("bigint"))
    df.write.parquet(target)
    found = read_foreign_layer(spark, target, SILVER)
    assert found.schema["quantity"].dataType == SILVER["quantity"].dataType
    assert found.first()["quantity"] == 3


def test_static_overwrite_drops_partitions_dynamic_keeps_them(spark, tmp_path):
    old = silver(spark, {"country": "US"}, {"country": "CA"})
    new = silver(spark, {"order_id": "new", "country": "US"})
    for mode, left in (("static", ["new"]), ("dynamic", ["1", "new"])):
        target = str(tmp_path / mode)
        write_layer(old, target, partition_by="country")
        write_layer(new, target, partition_by="country", partition_overwrite=mode)
        assert _ids(spark, target) == left


def test_append_adds_a_rerun_again(spark, tmp_path):
    target = str(tmp_path / "t")
    for _ in range(2):
        append_layer(silver(spark, {}, {}), target)
    assert _ids(spark, target) == ["0", "0", "1", "1"]
    assert all(f.name.endswith(".snappy.parquet") for f in _data_files(target))


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """A country with a third of all rows is split; the small ones are not scattered."""
    target = str(tmp_path / "t")
    values = {
        "order_id": F.sha2(F.col("id").cast("string"), 256),
        "order_date": F.lit("2024-01-05").cast("date"),
        "country": F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 8)),
    }
    df = spark.range(0, 120_000, 1, 8).select(
        *[values.get(f.name, F.lit("1").cast(f.dataType)).alias(f.name) for f in SILVER]
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        write_layer(df, target, partition_by="country")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {p.name: len(_data_files(p)) for p in Path(target).glob("*/country=*")}
    assert files["country=hot"] >= 3
    assert read_layer(spark, target, SILVER).count() == 120_000


def test_without_adaptive_execution_rows_stay_where_they_are(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_layer(silver(spark, {}, {}), str(tmp_path / "t"), partition_by="country")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert _ids(spark, str(tmp_path / "t")) == ["0", "1"]


def test_null_tests_reach_the_scan(spark, tmp_path):
    from frames import plan_of

    target = str(tmp_path / "t")
    write_layer(silver(spark, {}), target, partition_by="country")
    plan = plan_of(drop_missing_critical(read_layer(spark, target, SILVER)))
    for name in ("order_id", "order_date", "customer_id"):
        assert f"IsNotNull({name})" in plan


def test_open_source_by_path(spark, tmp_path):
    write_layer(silver(spark, {}), str(tmp_path / "t"))
    assert open_source(spark, str(tmp_path / "t"), SILVER).count() == 1
