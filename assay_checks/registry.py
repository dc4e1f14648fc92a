"""Every checked query, over the whole tables of a scale-factor folder."""

from __future__ import annotations

import atexit
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from assay.operators import (
    align,
    dedup,
    drop_missing_critical,
    gold_metrics,
    positive_measures,
    silver_metrics,
    typed_orders,
)
from assay.plans import (
    bronze_to_silver,
    bronze_to_silver_basic,
    gold_having,
    gold_orders,
    gold_orders_any_amount,
    gold_orders_basic,
    gold_report,
    merge_new_runs,
    run_medallion,
    silver_inspect,
    silver_orders,
    silver_orders_basic,
    silver_to_gold,
    silver_to_gold_basic,
    split_orders,
)
from assay.schemas import BRONZE, GOLD, GOLD_BASIC, ORDER_KEY, REJECTED, SILVER, Layout
from assay import versions
from assay.sinks import land_bronze, register_table, write_layer
from assay.sources import fill_orders, find_bronze, read_bronze_csv, read_layer, read_table
from assay.sources.bronze import CSV_QUOTING
from assay.workspace import Files, new_folder
from assay_checks.star_bronze import star_bronze

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2024, 1, 5)
DATABASE = "assay_checks"


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_orders(star_bronze(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_orders(star_bronze(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_orders(_silver(spark, sf_dir), exact_cents=True)


def _stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The same rows from files, for a query that reads them more than once: joins and choices are worked
    out one time."""
    folder = f"{new_folder(spark)}/rows"
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    drifted = star_bronze(spark, sf_dir).select(
        "unit_price",
        "quantity",
        F.col("order_id").alias("ORDER_ID"),
        "product",
        F.lit("web").alias("channel"),
        "customer_id",
        "order_date",
    )
    return align(drifted, BRONZE)


def bronze_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = Layout(new_folder(spark))
    land_bronze(star_bronze(spark, sf_dir), layout.bronze)
    return read_bronze_csv(spark, layout.bronze)


def _write_csv(rows: DataFrame, folder: str) -> None:
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, **CSV_QUOTING}
    rows.write.mode("append").options(header=True, **options).csv(folder)


def _line(part: int):
    return F.col("l_linenumber") % 3 == part


def _numbered_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze with the line number that its order ids end in."""
    rows = star_bronze(spark, sf_dir)
    return rows.withColumn("l_linenumber", F.substring_index("order_id", "-", -1).cast("int"))


def bronze_mixed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files flat in the root, in a run's folder and in a plain one."""
    layout = Layout(new_folder(spark))
    rows = _numbered_bronze(spark, sf_dir)
    _write_csv(rows.filter(_line(0)).drop("l_linenumber"), layout.bronze)
    land_bronze(rows.filter(_line(1)), layout.bronze, "20240105_000000")
    _write_csv(rows.filter(_line(2)).drop("l_linenumber"), f"{layout.bronze}/2024/01")
    return read_bronze_csv(spark, layout.bronze)


def bronze_drifted_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group of files without a column, one in another order, one with a column more."""
    layout = Layout(new_folder(spark))
    rows = _numbered_bronze(spark, sf_dir)
    bare = rows.drop("l_linenumber")
    _write_csv(rows.filter(_line(0)).drop("l_linenumber", "country"), f"{layout.bronze}/a")
    _write_csv(rows.filter(_line(1)).select(*reversed(bare.columns)), f"{layout.bronze}/b")
    extra = rows.filter(_line(2)).select(F.lit("web").alias("channel"), *bare.columns)
    _write_csv(extra, f"{layout.bronze}/c")
    return read_bronze_csv(spark, layout.bronze)


def bronze_line_breaks_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a line break in them, through the files and the silver job."""
    layout = Layout(new_folder(spark))
    broken = F.when(
        F.col("customer_id").cast("int") % 7 == 0, F.regexp_replace("product", " ", "\n")
    ).otherwise(F.col("product"))
    land_bronze(star_bronze(spark, sf_dir).withColumn("product", broken), layout.bronze, multi_line=True)
    bronze_to_silver(layout.bronze, layout.silver, multi_line=True)
    return read_layer(spark, layout.silver, SILVER)


def _quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with prices in quarters: sums of such doubles are exact in any order."""
    price = F.floor(F.col("unit_price") * 4) / 4
    return _silver(spark, sf_dir).withColumns(
        {"unit_price": price, "total_amount": F.col("quantity") * price}
    )


def any_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of amounts from 2**-20 to 2**46: plain sums of such doubles change with their order."""
    line = F.substring_index("order_id", "-", -1).cast("int")
    key = F.substring_index("order_id", "-", 1).cast("bigint")
    power = (key * 7 + line) % 61 - 20
    rows = _quarters(spark, sf_dir).withColumn("total_amount", F.col("quantity") * F.pow(F.lit(2.0), power))
    return gold_orders_any_amount(rows)


def silver_basic_mixed_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_bronze(spark, sf_dir)
    return silver_orders_basic(rows.toDF(*[name.title() for name in rows.columns]))


def medallion_from_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs by catalog names."""
    layout = Layout(new_folder(spark))
    land_bronze(star_bronze(spark, sf_dir), layout.bronze)
    bronze = register_table(
        spark,
        _table_name(spark, "bronze_orders"),
        layout.bronze,
        StructType([*BRONZE, StructField("run", StringType())]),
        partition_by="run",
        file_format="csv",
    )
    bronze_to_silver(bronze, layout.silver)
    silver = register_table(spark, _table_name(spark, "silver_orders"), layout.silver, SILVER)
    silver_to_gold(silver, layout.gold, exact_cents=True)
    return read_layer(spark, layout.gold, GOLD)


def _written_silver(spark: SparkSession, sf_dir: str, partition_by: str | None) -> DataFrame:
    layout = Layout(new_folder(spark))
    bronze_to_silver(star_bronze(spark, sf_dir), layout.silver, partition_by=partition_by)
    return read_layer(spark, layout.silver, SILVER)


def silver_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = Layout(new_folder(spark))
    for _ in range(2):
        bronze_to_silver_basic(star_bronze(spark, sf_dir), layout.silver)
    return read_layer(spark, layout.silver, SILVER)


def _written_gold(spark: SparkSession, sf_dir: str, partition_by: str | None) -> DataFrame:
    layout = Layout(new_folder(spark))
    silver_to_gold(
        _silver(spark, sf_dir), layout.gold, partition_by=partition_by, exact_cents=True
    )
    return read_layer(spark, layout.gold, GOLD)


def gold_basic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = Layout(new_folder(spark))
    silver_to_gold_basic(_silver(spark, sf_dir), layout.gold, exact_cents=True)
    return read_layer(spark, layout.gold, GOLD_BASIC)


def empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold written once, then a second batch in which every row fails the rules."""
    layout = Layout(new_folder(spark))
    silver = _silver(spark, sf_dir)
    silver_to_gold(silver, layout.gold, exact_cents=True)
    silver_to_gold(
        silver.withColumn("quantity", -F.col("quantity")), layout.gold, exact_cents=True
    )
    return read_layer(spark, layout.gold, GOLD)


def bronze_blank_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that begin with blank lines, with a byte order mark or with their header."""
    layout = Layout(new_folder(spark))
    rows = star_bronze(spark, sf_dir)
    pieces, header = 24, ",".join(rows.columns)
    starts = F.element_at(F.array(F.lit("\n  \n"), F.lit("\ufeff"), F.lit("")), (F.col("piece") % 3 + 1).cast("int"))
    heads = spark.range(pieces).select(F.col("id").cast("int").alias("piece"), F.lit(0).alias("place")).withColumn(
        "line", F.concat(starts, F.lit(header))
    )
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", **CSV_QUOTING}
    lines = rows.select(
        F.pmod(F.xxhash64("order_id"), F.lit(pieces)).cast("int").alias("piece"),
        F.lit(1).alias("place"),
        F.to_csv(F.struct(*rows.columns), options).alias("line"),
    )
    (
        heads.unionByName(lines)
        .repartition("piece")
        .sortWithinPartitions("piece", "place")
        .select("piece", "line")
        .write.partitionBy("piece")
        .text(layout.bronze)
    )
    return read_bronze_csv(spark, layout.bronze)


def bronze_manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs landed, one of them tried twice, and files of another writer: rows by the ledger and all
    rows, before and after the rules."""
    layout = Layout(new_folder(spark))
    rows = _numbered_bronze(spark, sf_dir)
    for part, batch in ((0, "zero"), (1, "one"), (1, "one")):
        land_bronze(rows.filter(_line(part)), layout.bronze, "20240105_000000", batch=batch)
    _write_csv(rows.filter(_line(2)).drop("l_linenumber"), f"{layout.bronze}/other")
    known = sum(landing.rows for _, landing in find_bronze(spark, layout.bronze).landed)
    counts = bronze_to_silver(layout.bronze, layout.silver, metrics=True).metrics
    names = ["landed_rows", "raw_rows", "clean_rows", "removed_rows"]
    values = {"landed_rows": known, **counts}
    return spark.createDataFrame(
        [tuple(values[n] for n in names)], ", ".join(f"{n} bigint" for n in names)
    )


def silver_publish_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of two thirds of the lines, then what a write of all lines leaves that is killed at its
    commit, then that write once more: what readers see after each step."""
    layout = Layout(new_folder(spark))
    files = Files(spark)
    rows = _stored(spark, _numbered_bronze(spark, sf_dir))
    bronze_to_silver(rows.filter(~_line(2)), layout.silver, partition_by="country")
    silver_orders(rows).write.partitionBy("country").parquet(f"{layout.silver}/v-killed")
    files.create(f"{layout.silver}/{versions.COMMITS}/{2:012}.json", '{"batches": {}, "partit')
    killed = read_layer(spark, layout.silver, SILVER).withColumn("seen", F.lit("after the kill"))
    bronze_to_silver(rows, layout.silver, partition_by="country")
    rerun = read_layer(spark, layout.silver, SILVER).withColumn("seen", F.lit("after the rerun"))
    return killed.unionByName(rerun)


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver brought up run by run: two thirds of the lines, then late copies of the first third that
    come before the rows there are, with the last third."""
    layout = Layout(new_folder(spark))
    rows = _stored(spark, _numbered_bronze(spark, sf_dir))
    late = rows.filter(_line(0)).withColumn("product", F.lit("A late copy"))
    for batch in (rows.filter(_line(0)), rows.filter(_line(1)), late.unionByName(rows.filter(_line(2)))):
        land_bronze(batch, layout.bronze)
        merge_new_runs(spark, layout.bronze, layout.silver, buckets=16)
    return read_layer(spark, layout.silver, SILVER)


def _split(spark: SparkSession, sf_dir: str) -> tuple[Layout, str, dict[str, int]]:
    layout = Layout(new_folder(spark))
    rejected = f"{layout.base}/rejected"
    *_, counts = split_orders(star_bronze(spark, sf_dir), layout.silver, rejected, partition_by="country")
    return layout, rejected, counts


def silver_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that silver turned away, as they came, with the rule that each failed."""
    _, rejected, _ = _split(spark, sf_dir)
    return read_layer(spark, rejected, REJECTED)


def silver_beside_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from the same pass, with the counts that add up to all of bronze."""
    layout, _, counts = _split(spark, sf_dir)
    reasons = sum(n for name, n in counts.items() if not name.endswith("_rows"))
    silver = read_layer(spark, layout.silver, SILVER)
    return silver.withColumns(
        {"removed_rows": F.lit(counts["removed_rows"]).cast("bigint"), "with_reason": F.lit(reasons).cast("bigint")}
    )


def silver_batches_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches appended to basic silver, each of them twice."""
    layout = Layout(new_folder(spark))
    rows = _numbered_bronze(spark, sf_dir)
    for _ in range(2):
        for part in range(3):
            bronze_to_silver_basic(
                rows.filter(_line(part)).drop("l_linenumber"), layout.silver, batch=f"lines {part}"
            )
    return read_layer(spark, layout.silver, SILVER)


def catalog_by_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table over silver by country, brought up after one country was written anew."""
    layout = Layout(new_folder(spark))
    table = _table_name(spark, "silver_orders")
    silver = _silver(spark, sf_dir)
    bronze_to_silver(star_bronze(spark, sf_dir), layout.silver, partition_by="country")
    register_table(spark, table, layout.silver, SILVER, partition_by="country")
    doubled = silver.filter("country = 'CANADA'").withColumn("quantity", F.col("quantity") * 2)
    write_layer(doubled, layout.silver, partition_by="country", partition_overwrite="dynamic")
    register_table(spark, table, layout.silver, SILVER, partition_by="country")
    return read_table(spark, table, SILVER)


def partition_null_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layers of orders, half of which have no country: one write gives up its partitions."""
    layout = Layout(new_folder(spark))
    half = F.when(F.crc32(F.col("order_id").cast("binary")) % 2 == 0, F.col("country"))
    rows = _stored(spark, _silver(spark, sf_dir).withColumn("country", half))
    out = []
    for share in (0.25, 0.75):
        target = f"{layout.silver}-{share}"
        result = write_layer(rows, target, partition_by="country", null_share=share)
        found = read_layer(spark, target, SILVER).drop("country")
        out.append(
            found.withColumns(
                {"null_share": F.lit(share), "partitions": F.lit(",".join(result.partition_by))}
            )
        )
    return out[0].unionByName(out[1])


def _drop_tables(spark: SparkSession, names: list[str]) -> None:
    # Without a session there is no catalog left to clear.
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if not spark.catalog.listTables(DATABASE):
        spark.sql(f"DROP DATABASE IF EXISTS {DATABASE}")


_made: list[str] = []


def _table_name(spark: SparkSession, layer: str) -> str:
    """A new name in the checks' database: an earlier result may still be read from its own table.

    The tables are dropped when the driver ends in good order, as their folders are."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{new_folder(spark)}'")
    if not _made:
        atexit.register(_drop_tables, spark, _made)
    _made.append(f"{DATABASE}.{layer}_{uuid.uuid4().hex}")
    return _made[-1]


def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and silver both registered and read back by name."""
    layout = Layout(new_folder(spark))
    land_bronze(star_bronze(spark, sf_dir), layout.bronze)
    bronze = register_table(
        spark,
        _table_name(spark, "bronze_orders"),
        layout.bronze,
        StructType([*BRONZE, StructField("run", StringType())]),
        partition_by="run",
        file_format="csv",
    )
    bronze_to_silver(read_table(spark, bronze, BRONZE), layout.silver, partition_by="country")
    silver = register_table(
        spark, _table_name(spark, "silver_orders"), layout.silver, SILVER, partition_by="country"
    )
    return read_table(spark, silver, SILVER)


def catalog_sql_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue report as SQL text over a registered gold table."""
    layout = Layout(new_folder(spark))
    silver_to_gold(
        _silver(spark, sf_dir), layout.gold, partition_by="order_date", exact_cents=True
    )
    gold = register_table(
        spark, _table_name(spark, "gold_orders"), layout.gold, GOLD, partition_by="order_date"
    )
    return spark.sql(
        "SELECT order_date, country, product, total_quantity, total_revenue"
        f" FROM {gold} ORDER BY order_date, country, product"
    )


def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = Layout(new_folder(spark))
    run_medallion(
        spark,
        star_bronze(spark, sf_dir),
        layout,
        silver_partition="country",
        gold_partition="country",
        exact_cents=True,
    )
    return read_layer(spark, layout.gold, GOLD)


def generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return fill_orders(keys, "o_orderkey", seed=42, as_of_date=AS_OF)


def generated_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingest runs of the same generated orders: the second adds copies, silver keeps one each."""
    layout = Layout(new_folder(spark))
    land_bronze(generate(spark, sf_dir), layout.bronze, "20240105_000000")
    run_medallion(
        spark, generate(spark, sf_dir), layout, stamp="20240105_010000", exact_cents=True
    )
    return read_layer(spark, layout.gold, GOLD)


QUERIES: dict[str, Query] = {
    "align_schema": align_schema,
    "typed_orders": _typed,
    "drop_missing_critical": lambda s, d: drop_missing_critical(_typed(s, d)),
    "positive_measures": lambda s, d: positive_measures(_typed(s, d)),
    "dedup_orders": lambda s, d: dedup(
        _typed(s, d).transform(drop_missing_critical).transform(positive_measures), ORDER_KEY
    ),
    "silver_orders": _silver,
    "silver_orders_basic": lambda s, d: silver_orders_basic(star_bronze(s, d)),
    "dq_metrics_silver": lambda s, d: silver_metrics(star_bronze(s, d)),
    "gold_orders": _gold,
    "gold_orders_basic": lambda s, d: gold_orders_basic(_silver(s, d), exact_cents=True),
    "gold_having": lambda s, d: gold_having(
        silver_orders_basic(star_bronze(s, d)), exact_cents=True
    ),
    "dq_metrics_gold": lambda s, d: gold_metrics(_silver(s, d)),
    "gold_orders_double": lambda s, d: gold_orders(_quarters(s, d)),
    "gold_basic_double": lambda s, d: gold_orders_basic(_quarters(s, d)),
    "gold_orders_any_amount": any_amount,
    "silver_basic_mixed_case": silver_basic_mixed_case,
    "bronze_csv_roundtrip": bronze_csv_roundtrip,
    "bronze_mixed_layout": bronze_mixed_layout,
    "bronze_drifted_headers": bronze_drifted_headers,
    "bronze_line_breaks_roundtrip": bronze_line_breaks_roundtrip,
    "medallion_from_catalog": medallion_from_catalog,
    "silver_flat_roundtrip": lambda s, d: _written_silver(s, d, None),
    "silver_partitioned_roundtrip": lambda s, d: _written_silver(s, d, "country"),
    "silver_append_roundtrip": silver_append_roundtrip,
    "gold_partitioned_roundtrip": lambda s, d: _written_gold(s, d, "country"),
    "gold_flat_roundtrip": lambda s, d: _written_gold(s, d, None),
    "gold_basic_roundtrip": gold_basic_roundtrip,
    "partition_fallback": lambda s, d: _written_gold(s, d, "no_such_column"),
    "empty_guard": empty_guard,
    "catalog_roundtrip": catalog_roundtrip,
    "catalog_sql_report": catalog_sql_report,
    "silver_inspect": lambda s, d: silver_inspect(_silver(s, d)),
    "gold_report": lambda s, d: gold_report(_gold(s, d)),
    "generate_orders": generate,
    "medallion_end_to_end": medallion_end_to_end,
    "generated_end_to_end": generated_end_to_end,
    "bronze_blank_heads": bronze_blank_heads,
    "bronze_manifest_counts": bronze_manifest_counts,
    "silver_publish_recovery": silver_publish_recovery,
    "silver_incremental": silver_incremental,
    "silver_rejected": silver_rejected,
    "silver_beside_rejected": silver_beside_rejected,
    "silver_batches_once": silver_batches_once,
    "catalog_by_difference": catalog_by_difference,
    "partition_null_heavy": partition_null_heavy,
}
