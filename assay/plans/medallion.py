"""The stages as jobs: read, transform, check, write, and all of them in a row."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from assay import versions
from assay.operators import gold_rules, rollup
from assay.operators.metrics import count_groups, group_rows
from assay.plans.gold import gold_orders, gold_orders_any_amount, gold_orders_basic
from assay.plans.incremental import BUCKETED_SILVER, merge_new_runs
from assay.plans.silver import silver_orders, silver_orders_basic
from assay.schemas import GOLD, SILVER, Layout
from assay.sinks import (
    SKIPPED_EMPTY,
    WRITTEN,
    WriteResult,
    append_layer,
    land_bronze,
    register_table,
    staging_folder,
    write_layer,
)
from assay.sources import find_bronze, is_path, open_bronze, open_source
from assay.workspace import Files

logger = logging.getLogger(__name__)

#: For ``metrics``: only the counts that need no further pass.
WRITTEN_ROWS = "written"


class StageFailed(RuntimeError):
    """A stage raised; later stages were not started."""

    def __init__(self, stage: str):
        super().__init__(f"stage {stage} failed")
        self.stage = stage


@dataclass(frozen=True)
class StageResult:
    stage: str
    write: WriteResult
    metrics: dict[str, int] = field(default_factory=dict)


def bronze_to_silver(
    bronze: DataFrame | str,
    target: str,
    *,
    partition_by: str | None = None,
    partition_overwrite: str = "static",
    null_share: float | None = None,
    survivor_order: Sequence[str | Column] = (),
    reject_non_finite: bool = False,
    multi_line: bool = False,
    one_header: bool = False,
    rebalance: bool = True,
    metrics: bool | str = False,
) -> StageResult:
    """Write silver in one pass over bronze: a frame, a catalog table's name or a folder of CSV files.

    ``metrics=WRITTEN_ROWS`` gives ``clean_rows``, from the footers of what was written.
    ``metrics=True`` adds ``raw_rows`` and ``removed_rows``. Of a folder that :func:`land_bronze` filled
    the ledger knows the rows, so its text is read once; other files, and frames, are counted in a
    second pass, which for Parquet reads footers only.
    """
    found = None
    if isinstance(bronze, str) and is_path(bronze) and not one_header:
        found = find_bronze(SparkSession.active(), bronze, multi_line=multi_line)
        bronze = found.frame()
    elif isinstance(bronze, str):
        bronze = open_bronze(
            SparkSession.active(), bronze, multi_line=multi_line, one_header=one_header
        )
    write = write_layer(
        silver_orders(
            bronze, survivor_order=survivor_order, reject_non_finite=reject_non_finite
        ),
        target,
        partition_by=partition_by,
        partition_overwrite=partition_overwrite,
        null_share=null_share,
        rebalance=rebalance,
    )
    counts = {}
    if metrics:
        counts = {"clean_rows": write.rows}
    if metrics is True:
        raw_rows = found.rows() if found is not None else bronze.count()
        counts = {
            "raw_rows": raw_rows,
            "clean_rows": write.rows,
            "removed_rows": raw_rows - write.rows,
        }
    if counts:
        logger.info("bronze to silver: %s", counts)
    return StageResult("bronze_to_silver", write, counts)


def bronze_to_silver_basic(
    bronze: DataFrame, target: str, *, batch: str | None = None
) -> StageResult:
    """Append typed orders with all critical fields, in one pass without a shuffle. With the name of a
    ``batch`` a rerun adds nothing."""
    return StageResult(
        "bronze_to_silver_basic", append_layer(silver_orders_basic(bronze), target, batch=batch)
    )


def silver_to_gold(
    silver: DataFrame | str,
    target: str,
    *,
    partition_by: str | None = None,
    partition_overwrite: str = "static",
    null_share: float | None = None,
    exact_cents: bool = False,
    any_amount: bool = False,
    rebalance: bool = True,
    metrics: bool = False,
) -> StageResult:
    """Write gold in one pass over silver: a frame, a catalog table's name or a Parquet folder.

    ``any_amount`` takes exact sums of doubles (:func:`gold_orders_any_amount`), without metrics.
    With ``metrics`` the rollup before its rules is stored beside the target for as long as the job
    runs: groups that the rules drop must exist to be counted.
    """
    spark = SparkSession.active()
    silver = open_source(spark, silver, SILVER)
    write = partial(
        write_layer,
        target=target,
        partition_by=partition_by,
        partition_overwrite=partition_overwrite,
        null_share=null_share,
        rebalance=rebalance,
    )
    if any_amount and (metrics or exact_cents):
        raise ValueError("any_amount goes without exact_cents and metrics")
    if any_amount:
        return StageResult("silver_to_gold", write(gold_orders_any_amount(silver)))
    if not metrics:
        return StageResult("silver_to_gold", write(gold_orders(silver, exact_cents=exact_cents)))
    stored = staging_folder(target)
    try:
        rollup(silver, group_rows(), exact_cents=exact_cents).write.parquet(stored)
        groups = spark.read.parquet(stored)
        counts = count_groups(groups).first().asDict()
        result = write(gold_rules(groups).select(*GOLD.names))
    finally:
        files = Files(spark)
        files.delete(stored)
        if not files.list(target):
            files.delete(target)
    logger.info("silver to gold: %s", counts)
    return StageResult("silver_to_gold", result, counts)


def silver_to_gold_basic(
    silver: DataFrame, target: str, *, exact_cents: bool = False
) -> StageResult:
    """Overwrite gold with the basic rollup, empty or not."""
    gold = gold_orders_basic(silver, exact_cents=exact_cents)
    return StageResult("silver_to_gold_basic", write_layer(gold, target, guard=False))


def _stage(name: str, run: Callable[[], StageResult]) -> StageResult:
    try:
        return run()
    except Exception as error:
        raise StageFailed(name) from error


def run_medallion(
    spark: SparkSession,
    incoming: DataFrame,
    layout: Layout,
    *,
    stamp: str | None = None,
    batch: str | None = None,
    silver_partition: str | None = None,
    gold_partition: str | None = None,
    bronze_source: str | None = None,
    silver_source: str | None = None,
    database: str | None = None,
    incremental: bool = False,
    multi_line: bool = False,
    one_header: bool = False,
    exact_cents: bool = False,
    rebalance: bool = True,
    metrics: bool | str = False,
) -> list[StageResult]:
    """Land ``incoming`` as a new bronze run, then rebuild silver and gold from all runs. With
    ``incremental`` silver lies in buckets of order ids, and only those that new runs touch are
    written (see :func:`merge_new_runs`).

    A stage starts only when the one before is done; a failure raises :class:`StageFailed` with the
    stage's name. Without a valid row silver is skipped, and so is gold if there never was a silver; one
    that is missing for any other reason fails the run.
    With the name of a ``batch`` a rerun of a run that failed lands its rows once.
    ``bronze_source`` and ``silver_source`` are what the later stages read instead of the layout's
    folders: a catalog table's name or a path. With ``database`` the layers are registered there as
    ``silver_orders`` and ``gold_orders``, anew if they were registered over another place.
    """

    if incremental and (silver_partition or bronze_source or one_header):
        raise ValueError("incremental silver has its own partitions and reads the layout's bronze folder")
    statuses: dict[str, str] = {}

    def register(table: str, result: StageResult, schema: StructType) -> None:
        if database is None or result.write.status == SKIPPED_EMPTY:
            return
        register_table(
            spark,
            f"{database}.{table}",
            result.write.target,
            schema,
            partition_by=next(iter(result.write.partition_by), None),
            replace=True,
        )

    def ingest() -> StageResult:
        folder = land_bronze(incoming, layout.bronze, stamp, multi_line=multi_line, batch=batch)
        return StageResult("ingest", WriteResult(WRITTEN, folder))

    def merged_silver() -> StageResult:
        write, counts = merge_new_runs(spark, layout.bronze, layout.silver, multi_line=multi_line)
        return StageResult("bronze_to_silver", write, counts if metrics else {})

    def to_silver() -> StageResult:
        if incremental:
            result = merged_silver()
            register("silver_orders", result, BUCKETED_SILVER)
            statuses["bronze_to_silver"] = result.write.status
            return result
        result = bronze_to_silver(
            bronze_source or layout.bronze,
            layout.silver,
            partition_by=silver_partition,
            multi_line=multi_line,
            one_header=one_header,
            rebalance=rebalance,
            metrics=metrics,
        )
        register("silver_orders", result, SILVER)
        statuses["bronze_to_silver"] = result.write.status
        return result

    def to_gold() -> StageResult:
        source = silver_source or layout.silver
        if is_path(source) and not versions.is_there(spark, source):
            if source != layout.silver or statuses.get("bronze_to_silver") != SKIPPED_EMPTY:
                raise FileNotFoundError(f"no silver at {source}")
            if versions.is_there(spark, layout.gold):
                raise FileNotFoundError(f"silver at {source} is gone, and gold was made from it")
            logger.warning("No silver at %s yet, skipping gold.", source)
            return StageResult("silver_to_gold", WriteResult(SKIPPED_EMPTY, layout.gold))
        result = silver_to_gold(
            source,
            layout.gold,
            partition_by=gold_partition,
            exact_cents=exact_cents,
            rebalance=rebalance,
            metrics=bool(metrics),
        )
        register("gold_orders", result, GOLD)
        return result

    return [
        _stage("ingest", ingest),
        _stage("bronze_to_silver", to_silver),
        _stage("silver_to_gold", to_gold),
    ]
