"""Silver and the orders that it turned away, from one pass over bronze."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators import align, cast_orders, dedup, rejection_reason, with_total_amount
from assay.schemas import BRONZE, ORDER_KEY, REJECTED, SILVER
from assay.sinks import WriteResult, staging_folder, write_layer
from assay.sources import read_layer
from assay.workspace import Files

logger = logging.getLogger(__name__)

DUPLICATE = "duplicate"

_RAW, _ROW, _REASON = "__raw_", "__row", "__reason"


def split_orders(
    bronze: DataFrame,
    target: str,
    rejected: str,
    *,
    partition_by: str | None = None,
    survivor_order: Sequence[str | Column] = (),
    reject_non_finite: bool = False,
    rebalance: bool = True,
) -> tuple[WriteResult, WriteResult, dict[str, int]]:
    """Publish silver at ``target`` and all other rows of bronze, as they came and with a reason, at
    ``rejected``; the counts are ``raw_rows``, ``clean_rows``, ``removed_rows`` and one for each reason.

    Bronze is read once: its rows are stored below the target, typed and as they came, each with a
    number. The survivor of each id is chosen as in :func:`silver_orders`, by the typed columns and then
    by what the row came as; the other valid rows are those whose number was not chosen, found by a
    join on it. So an id with a third of all rows leaves each task of the choice as one row, and its
    copies are spread over all tasks of the join.

    Rejected orders are published first, without a guard: none is a result, too. An empty country or
    product is null there, as in every layer; columns of bronze beyond its schema are dropped.
    """
    spark = bronze.sparkSession
    files = Files(spark)
    source = align(bronze, BRONZE, enforce_types=False)
    raw = {f"{_RAW}{name}": F.col(name).cast("string") for name in BRONZE.names}
    typed = cast_orders(source.withColumns(raw)).withColumns(
        {_REASON: rejection_reason(reject_non_finite=reject_non_finite), _ROW: F.monotonically_increasing_id()}
    )
    staged = staging_folder(target)
    try:
        typed.write.parquet(f"{staged}/typed")
        rows = spark.read.schema(typed.schema).parquet(f"{staged}/typed")
        valid = rows.filter(F.col(_REASON).isNull())
        order = [*survivor_order, *[name for name in BRONZE.names if name not in ORDER_KEY], *raw, _ROW]
        dedup(valid, ORDER_KEY, order).write.parquet(f"{staged}/chosen")
        chosen = spark.read.schema(valid.schema).parquet(f"{staged}/chosen")

        others = valid.join(chosen.select(_ROW), _ROW, "left_anti").withColumn(_REASON, F.lit(DUPLICATE))
        turned_away = rows.filter(F.col(_REASON).isNotNull()).unionByName(others.select(*rows.columns))
        named = turned_away.select(
            *[F.col(f"{_RAW}{name}").alias(name) for name in BRONZE.names], F.col(_REASON).alias("reason")
        )
        # The commit at the target clears the staging folder, so it comes last.
        away = write_layer(named, rejected, guard=False)
        clean = write_layer(
            chosen.transform(with_total_amount).select(*SILVER.names),
            target,
            partition_by=partition_by,
            rebalance=rebalance,
        )
    finally:
        files.delete(staged)
        if not files.list(target):
            files.delete(target)
    reasons = read_layer(spark, rejected, REJECTED).groupBy("reason").count().collect()
    counts = {
        "raw_rows": clean.rows + away.rows,
        "clean_rows": clean.rows,
        "removed_rows": away.rows,
        **{row["reason"]: row["count"] for row in reasons},
    }
    logger.info("bronze to silver: %s", counts)
    return clean, away, counts
