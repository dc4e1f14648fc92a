from __future__ import annotations

import pytest
from frames import bronze, silver

from assay.schemas import BRONZE, SILVER
from assay.sinks import append_layer, compact_layer, land_bronze, register_table, write_layer
from assay.sources import open_source, read_layer, read_table


@pytest.fixture(scope="module")
def db(spark, tmp_path_factory):
    spark.sql(f"CREATE DATABASE layers LOCATION '{tmp_path_factory.mktemp('db')}'")
    yield "layers"
    spark.sql("DROP DATABASE layers CASCADE")


def _countries(spark, table):
    return sorted(r["country"] for r in spark.table(table).collect())


def test_partitions_follow_the_files(spark, db, tmp_path):
    table, path = f"{db}.silver_orders", str(tmp_path / "it's")
    write_layer(silver(spark, {"country": "US"}, {"country": "007"}), path, partition_by="country")
    register_table(spark, table, path, SILVER, partition_by="country")
    assert _countries(spark, table) == ["007", "US"]

    write_layer(silver(spark, {"country": "US"}, {"country": "CA"}), path, partition_by="country")
    register_table(spark, table, path, SILVER, partition_by="country")
    assert _countries(spark, table) == ["CA", "US"]
    shown = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    assert shown == ["country=CA", "country=US"]

    df = read_table(spark, table, SILVER)
    assert df.columns == SILVER.names
    assert open_source(spark, table, SILVER).count() == 2


def test_sql_over_registered_tables(spark, db, tmp_path):
    path = str(tmp_path / "s")
    write_layer(silver(spark, {"quantity": 2}, {"quantity": 3}), path)
    register_table(spark, f"{db}.plain", path, SILVER)
    assert spark.sql(f"SELECT sum(quantity) FROM {db}.plain").first()[0] == 5
    assert len(spark.sql(f"SELECT * FROM {db}.plain LIMIT 10").collect()) == 2


def test_flat_table_shows_a_rewrite(spark, db, tmp_path):
    path = str(tmp_path / "s")
    for count in (1, 3):
        write_layer(silver(spark, *[{}] * count), path)
        register_table(spark, f"{db}.flat", path, SILVER)
        assert spark.table(f"{db}.flat").count() == count


def test_another_place_or_layout_registers_anew(spark, db, tmp_path):
    table = f"{db}.moved"
    write_layer(silver(spark, {"order_id": "a"}), str(tmp_path / "a"))
    write_layer(silver(spark, {"order_id": "b"}), str(tmp_path / "b"), partition_by="country")
    register_table(spark, table, str(tmp_path / "a"), SILVER)
    with pytest.raises(ValueError, match="replace=True"):
        register_table(spark, table, str(tmp_path / "b"), SILVER, partition_by="country")
    assert [r["order_id"] for r in spark.table(table).collect()] == ["a"]
    register_table(spark, table, str(tmp_path / "b"), SILVER, partition_by="country", replace=True)
    assert [r["order_id"] for r in spark.table(table).collect()] == ["b"]
    register_table(spark, table, str(tmp_path / "a"), SILVER, replace=True)
    assert [r["order_id"] for r in spark.table(table).collect()] == ["a"]
    assert read_layer(spark, str(tmp_path / "b"), SILVER).count() == 1


def test_a_table_that_owns_its_data_is_refused(spark, db, tmp_path):
    spark.sql(f"CREATE TABLE {db}.owned (a INT) USING parquet")
    with pytest.raises(ValueError, match="not an external table"):
        register_table(spark, f"{db}.owned", str(tmp_path / "x"), SILVER)


def test_unknown_partition_column(spark, db, tmp_path):
    with pytest.raises(ValueError, match="region"):
        register_table(spark, f"{db}.x", str(tmp_path / "x"), SILVER, partition_by="region")


def test_bronze_files_as_a_table(spark, db, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType

    path = str(tmp_path / "orders")
    schema = StructType([*BRONZE, StructField("run", StringType())])
    for number, stamp in enumerate(("20240105_101112", "20240106_101112")):
        land_bronze(bronze(spark, {"order_id": str(number), "product": 'a "b", c'}), path, stamp)
        register_table(
            spark, f"{db}.bronze", path, schema, partition_by="run", file_format="csv"
        )
        assert read_table(spark, f"{db}.bronze", BRONZE).count() == number + 1
    assert {r["product"] for r in spark.table(f"{db}.bronze").collect()} == {'a "b", c'}


def test_files_outside_the_partitions_are_refused(spark, db, tmp_path):
    root = tmp_path / "orders"
    land_bronze(bronze(spark, {}), str(root))
    (root / "flat.csv").write_text(",".join(BRONZE.names) + "\n")
    with pytest.raises(ValueError, match="flat.csv"):
        register_table(spark, f"{db}.hidden", str(root), _with_run(), partition_by="run", file_format="csv")


def _with_run():
    from pyspark.sql.types import StringType, StructField, StructType

    return StructType([*BRONZE, StructField("run", StringType())])


def test_partitions_follow_by_difference(spark, db, tmp_path, monkeypatch):
    """Of many partitions one is rewritten: only that one is touched, and nothing is listed."""
    table, path = f"{db}.many", str(tmp_path / "s")
    many = [{"order_id": str(i), "country": f"c/{i}" if i else None} for i in range(40)]
    write_layer(silver(spark, *many), path, partition_by="country")
    register_table(spark, table, path, SILVER, partition_by="country")
    assert spark.table(table).count() == 40
    new = silver(spark, {"order_id": "new", "country": "c/7"}, {"order_id": "more", "country": None})
    write_layer(new, path, partition_by="country", partition_overwrite="dynamic")
    said, sql = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: (said.append(text), sql(text, *a, **b))[1])
    register_table(spark, table, path, SILVER, partition_by="country")
    changed = [text for text in said if "PARTITION (" in text]
    assert len(changed) == 2 and all("SET LOCATION" in text for text in changed)
    assert not any("MSCK" in text or "SHOW PARTITIONS" in text for text in said)
    ids = {r["order_id"] for r in spark.table(table).collect()}
    assert ids == {str(i) for i in range(40)} - {"0", "7"} | {"new", "more"}
    write_layer(silver(spark, {"country": "c/1"}), path, partition_by="country")
    register_table(spark, table, path, SILVER, partition_by="country")
    assert [r["country"] for r in spark.table(table).collect()] == ["c/1"]


def test_a_layer_in_several_folders_is_compacted_first(spark, db, tmp_path):
    path = str(tmp_path / "s")
    for batch in ("a", "b"):
        append_layer(silver(spark, {}), path, batch=batch)
    with pytest.raises(ValueError, match="compact"):
        register_table(spark, f"{db}.pieces", path, SILVER)
    compact_layer(spark, path, SILVER)
    register_table(spark, f"{db}.pieces", path, SILVER)
    assert spark.table(f"{db}.pieces").count() == 2
