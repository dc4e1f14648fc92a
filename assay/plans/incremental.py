"""Silver from new runs only.

Silver lies in buckets of order ids. Its commit notes the runs and files that it was made from; what has
come since is typed and checked, and only the buckets that hold one of its ids are written anew. The
first of some copies in a fixed order is also the first of those that were first among parts of them,
so the result is the same as that of a rebuild from all runs.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from assay import versions
from assay.operators import dedup, with_total_amount
from assay.plans.silver import valid_orders
from assay.schemas import BRONZE, ORDER_KEY, SILVER
from assay.sinks import SKIPPED_EMPTY, WRITTEN, WriteResult, staging_folder, write_layer
from assay.sources import find_bronze, read_layer
from assay.workspace import Files

logger = logging.getLogger(__name__)

BUCKET = "id_bucket"
#: Buckets of a layer that no one has chosen a number for: at 100 TB of silver some 25 GB each.
BUCKETS = 4096

#: Silver as it lies in buckets, for the catalog.
BUCKETED_SILVER = StructType([*SILVER, StructField(BUCKET, IntegerType())])

_SOURCES, _COUNT = "sources", "buckets"
_PART = "__bucket_part"


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*ORDER_KEY), F.lit(buckets)).cast("int"))


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows by bucket and part of a bucket. There are as many parts as keep all tasks of a shuffle busy
    with so many buckets; each lies in one task, so a bucket gets at most one file for each."""
    parts = -(-int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // buckets)
    part = F.pmod(F.hash(*ORDER_KEY), F.lit(parts)).cast("int")
    return rows.withColumn(_PART, part).repartition(BUCKET, _PART)


def merge_new_runs(
    spark: SparkSession,
    bronze: str,
    target: str,
    *,
    buckets: int = BUCKETS,
    survivor_order: Sequence[str | Column] = (),
    reject_non_finite: bool = False,
    multi_line: bool = False,
) -> tuple[WriteResult, dict[str, int]]:
    """Bring silver up to the runs in a bronze folder, and tell ``new_sources`` and ``buckets`` written.

    Everything is read if the layer was not made by this function with the same number of ``buckets``,
    or if a run or file that it was made from has changed or is gone. ``survivor_order`` may name
    columns of silver, for nothing else of the earlier copies is known any more; it and
    ``reject_non_finite`` must stay the same from call to call.

    New rows are stored once, below the target, the first of the copies of each id, while the buckets that
    they touch are found. Rows that lie in those buckets meet them in one shuffle: it deals rows out by
    bucket and by parts of it, so that tasks hold whole ids and write to their own buckets. New runs
    without a valid row are noted and change nothing else.
    """
    files = Files(spark)
    found = find_bronze(spark, bronze, multi_line=multi_line)
    now = found.sources()
    before = versions.newest_commit(files, target)
    noted = before.notes if before is not None else {}
    known: dict[str, int] = noted.get(_SOURCES, {}) if noted.get(_COUNT) == buckets else {}
    if any(now.get(name) != size for name, size in known.items()):
        logger.warning("What %s was made from has changed, rebuilding it.", target)
        known = {}
    new = found.without(known.keys())
    counts = {"new_sources": len(now) - len(known), "buckets": 0}
    if known and not counts["new_sources"]:
        return WriteResult(SKIPPED_EMPTY, target, (BUCKET,), 0), counts
    notes = {_SOURCES: now, _COUNT: buckets}

    typed = StructType([field for field in BUCKETED_SILVER if field.name != "total_amount"])
    staged = staging_folder(target)
    try:
        rows = _bucketed(valid_orders(new.frame(), reject_non_finite=reject_non_finite), buckets)
        first = dedup(rows.select(*BRONZE.names, BUCKET), ORDER_KEY, survivor_order)
        first.select(*typed.names).write.parquet(staged)
        fresh = spark.read.schema(typed).parquet(staged)
        touched = [row[0] for row in fresh.select(BUCKET).distinct().collect()]
        counts["buckets"] = len(touched)
        if known and not touched:
            after = versions.commit(files, target, before, before.partitions, before.batches, notes)
            versions.clean(files, target, [before, after])
            return WriteResult(SKIPPED_EMPTY, target, (BUCKET,), 0), counts
        if known:
            held = read_layer(spark, target, BUCKETED_SILVER).filter(F.col(BUCKET).isin(touched))
            fresh = fresh.unionByName(held.select(*typed.names))
        chosen = _dealt(fresh.select(*BRONZE.names, BUCKET), buckets)
        if known:
            chosen = dedup(chosen, [BUCKET, _PART, *ORDER_KEY], survivor_order)
        write = write_layer(
            chosen.transform(with_total_amount).select(*BUCKETED_SILVER.names),
            target,
            partition_by=BUCKET,
            partition_overwrite="dynamic" if known else "static",
            notes=notes,
            rebalance=False,
        )
    finally:
        files.delete(staged)
        if not files.list(target):
            files.delete(target)
    if write.status == WRITTEN:
        logger.info("Merged %s into %s", counts, target)
    return write, counts
