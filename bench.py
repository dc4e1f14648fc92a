"""Times the headline queries and prints one JSON line.

Bronze is made from the star schema and written to Parquet first, so its joins are not timed. Each
query runs once to warm up and then BENCH_RUNS times (5); the median counts. ``plain_style`` holds the
same work the plain way: a bare query beside a bare query, a job with counts beside a job with a count
after every step; nothing kept, ``dropna`` and ``dropDuplicates``. ``jobs`` counts scans and shuffles
of everything that a run of each job executes, from Spark's event log; reads of footers alone and the
single rows of counts are left out.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.cluster import session_settings
from assay.operators import cast_orders, dedup
from assay.plans import (
    bronze_to_silver,
    gold_orders,
    run_medallion,
    silver_orders,
    silver_to_gold,
    valid_orders,
)
from assay.schemas import BRONZE, CRITICAL_FIELDS, GOLD, ORDER_KEY, ROLLUP_KEYS, SILVER, Layout
from assay.sinks import land_bronze
from assay.sources import read_bronze_csv, read_layer
from assay.workspace import new_folder
from assay_checks.star_bronze import star_bronze

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
EVENTS = tempfile.mkdtemp(prefix="assay-events-")


def session() -> SparkSession:
    stored = sum(f.stat().st_size for f in Path(SF_DIR).glob("*.parquet"))
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("assay-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "5g"))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", EVENTS)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config(map=session_settings(stored, CPUS))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work: Callable[[], None]) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def medians(*works: Callable[[], None]) -> list[float]:
    """One median per work. The runs alternate, so that a slow spell of the machine meets all alike."""
    for work in works:
        work()
    times = [[seconds(work) for work in works] for _ in range(RUNS)]
    return [round(statistics.median(column), 3) for column in zip(*times)]


def plan_shape(df: DataFrame) -> dict[str, int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {
        "scans": len(re.findall(r"FileScan ", plan)),
        "shuffles": len(re.findall(r"Exchange \w+", plan)),
    }


def job_shapes(names: list[str]) -> dict[str, dict[str, int]]:
    """Scans and shuffles of the executions that ran under these descriptions, as last planned."""
    described: dict[int, str] = {}
    plans: dict[int, dict] = {}
    for log in Path(EVENTS).iterdir():
        for line in log.open(errors="replace"):
            event = json.loads(line) if "sparkPlanInfo" in line else {}
            if event.get("description") in names:
                described[event["executionId"]] = event["description"]
            if "sparkPlanInfo" in event:
                plans[event["executionId"]] = event["sparkPlanInfo"]

    def nodes(plan: dict) -> list[tuple[str, str]]:
        own = (plan["nodeName"].strip(), plan["simpleString"])
        return [own, *(n for child in plan["children"] for n in nodes(child))]

    found = {name: {"scans": 0, "shuffles": 0} for name in names}
    for execution, name in described.items():
        for node, text in nodes(plans[execution]):
            footers = node.startswith("Scan parquet") and "ReadSchema: struct<>" in text
            found[name]["scans"] += node.startswith("Scan ") and not footers
            found[name]["shuffles"] += node == "Exchange" and "SinglePartition" not in text
    return found


# The same work the plain way.


def plain_clean(bronze: DataFrame) -> DataFrame:
    typed = cast_orders(bronze).withColumn("total_amount", F.col("quantity") * F.col("unit_price"))
    return (
        typed.dropna(subset=list(CRITICAL_FIELDS))
        .filter("quantity > 0")
        .filter("unit_price > 0")
        .dropDuplicates(list(ORDER_KEY))
    )


def plain_gold(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    groups = silver.groupBy(*ROLLUP_KEYS).agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("unit_price").alias("avg_unit_price"),
    )
    kept = groups.dropna(subset=list(ROLLUP_KEYS)).filter("total_quantity >= 0")
    return groups, kept.filter("total_revenue >= 0")


def plain_silver_job(bronze: DataFrame, write: Callable[[DataFrame], None]) -> None:
    bronze.count()
    clean = plain_clean(bronze)
    if clean.count():
        write(clean)


def plain_gold_job(silver: DataFrame, write: Callable[[DataFrame], None]) -> None:
    silver.count()
    groups, kept = plain_gold(silver)
    groups.count()
    if kept.count():
        write(kept)


def by_country(target: str) -> Callable[[DataFrame], None]:
    return lambda df: df.write.mode("overwrite").partitionBy("country").parquet(target)


def main() -> None:
    spark = session()
    inputs = Layout(new_folder(spark))
    # One file per core: a single small file would be one task, whatever the number of cores.
    star_bronze(spark, SF_DIR).repartition(CPUS).write.parquet(inputs.bronze)
    bronze = read_layer(spark, inputs.bronze, BRONZE)
    bronze_to_silver(bronze, inputs.silver)
    silver = read_layer(spark, inputs.silver, SILVER)

    def silver_written() -> None:
        target = new_folder(spark)
        bronze_to_silver(bronze, target, partition_by="country", metrics=True)
        run(read_layer(spark, target, SILVER))

    def gold_written() -> None:
        target = new_folder(spark)
        silver_to_gold(silver, target, partition_by="country", metrics=True)
        run(read_layer(spark, target, GOLD))

    def end_to_end() -> None:
        run_medallion(
            spark,
            bronze,
            Layout(new_folder(spark)),
            silver_partition="country",
            gold_partition="country",
            metrics=True,
        )

    def plain_silver_written() -> None:
        target = new_folder(spark)
        plain_silver_job(bronze, by_country(target))
        run(read_layer(spark, target, SILVER))

    def plain_gold_written() -> None:
        target = new_folder(spark)
        plain_gold_job(silver, by_country(target))
        run(read_layer(spark, target, GOLD))

    def plain_end_to_end() -> None:
        layout = Layout(new_folder(spark))
        land_bronze(bronze, layout.bronze)
        plain_silver_job(read_bronze_csv(spark, layout.bronze), by_country(layout.silver))
        plain_gold_job(read_layer(spark, layout.silver, SILVER), by_country(layout.gold))

    ours = {
        "dedup_orders": lambda: run(dedup(valid_orders(bronze), ORDER_KEY)),
        "silver_orders": lambda: run(silver_orders(bronze)),
        "gold_orders": lambda: run(gold_orders(silver_orders(bronze))),
        "gold_orders_exact": lambda: run(gold_orders(silver_orders(bronze), exact_cents=True)),
        "silver_partitioned_roundtrip": silver_written,
        "gold_partitioned_roundtrip": gold_written,
        "medallion_end_to_end": end_to_end,
    }
    plain = {
        "dedup_orders": lambda: run(valid_orders(bronze).dropDuplicates(list(ORDER_KEY))),
        "silver_orders": lambda: run(plain_clean(bronze)),
        "gold_orders": lambda: run(plain_gold(plain_clean(bronze))[1]),
        "silver_partitioned_roundtrip": plain_silver_written,
        "gold_partitioned_roundtrip": plain_gold_written,
        "medallion_end_to_end": plain_end_to_end,
    }
    timed, timed_plain = {}, {}
    for name, work in ours.items():
        timed[name], *rest = medians(work, *([plain[name]] if name in plain else []))
        if rest:
            timed_plain[name] = rest[0]
    jobs = [name for name in ours if ours[name].__name__ != "<lambda>"]
    for name in jobs:
        for label, work in ((name, ours[name]), (f"plain {name}", plain[name])):
            spark.sparkContext.setJobDescription(label)
            work()
    spark.sparkContext.setJobDescription(None)
    result = {
        "metric": "sum of median seconds, all headline queries",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "plain_style": timed_plain,
        "plans": {
            "dedup_orders": plan_shape(dedup(valid_orders(bronze), ORDER_KEY)),
            "silver_orders": plan_shape(silver_orders(bronze)),
            "gold_orders": plan_shape(gold_orders(silver_orders(bronze))),
            "gold_from_silver": plan_shape(gold_orders(silver)),
        },
        "bronze_rows": bronze.count(),
        "cpus": CPUS,
    }
    spark.stop()
    result["jobs"] = job_shapes([label for name in jobs for label in (name, f"plain {name}")])
    print(json.dumps(result))


if __name__ == "__main__":
    sys.exit(main())
