"""Guarded Parquet writes of silver and gold."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay import versions
from assay.sources.layers import read_layer
from assay.workspace import Files

logger = logging.getLogger(__name__)

WRITTEN = "written"
SKIPPED_EMPTY = "skipped_empty"
ALREADY_THERE = "already_there"

# Text columns that a layer may be partitioned by.
_TEXT_KEYS = ("country", "product")


@dataclass(frozen=True)
class WriteResult:
    """What a write did, the partition column it settled on, and how many rows it wrote."""

    status: str
    target: str
    partition_by: tuple[str, ...] = ()
    rows: int | None = None


def resolve_partition(df: DataFrame, name: str | None) -> list[str]:
    """``[name]`` if it is a column of ``df``, spelled exactly so; else a warning and no partitioning."""
    if name and name in df.columns:
        return [name]
    logger.warning("Partition column %r not found, writing without partitions.", name)
    return []


def blank_keys_as_null(df: DataFrame) -> DataFrame:
    """An empty country or product is null: a partition folder cannot hold an empty text, and the rows
    of a layer must not depend on how it is partitioned."""
    texts = {
        name: F.nullif(F.col(name), F.lit(""))
        for name, kind in df.dtypes
        if name in _TEXT_KEYS and kind == "string"
    }
    return df.withColumns(texts) if texts else df


def staging_folder(target: str) -> str:
    """A new folder below the target that no reader looks at; the next write clears what is left."""
    return f"{target.rstrip('/')}/_staging-{uuid.uuid4().hex}"


def write_layer(
    df: DataFrame,
    target: str,
    *,
    mode: str = "overwrite",
    partition_by: str | None = None,
    partition_overwrite: str = "static",
    null_share: float | None = None,
    compression: str = "snappy",
    rebalance: bool = True,
    guard: bool = True,
    batch: str | None = None,
    notes: dict | None = None,
) -> WriteResult:
    """Write ``df`` as Parquet, unless it has no rows: then leave the old target as it is. Without
    ``guard`` a result without rows is published as well.

    ``df`` is worked out once, into a new folder below the target; the footers there tell the number
    of rows. A commit then makes it the layer, or with ``partition_overwrite="dynamic"`` the place of
    its partitions, or with ``mode="append"`` one more folder of them: nothing is copied or moved, and
    a write that is killed leaves the old layer (see :mod:`assay.versions`). The layer before it stays
    until the next write, for readers that have begun.

    ``batch`` names what is appended: a batch of that name that is already in the layer is not written
    again. A static overwrite forgets the names. ``notes`` are kept with this version alone.

    ``null_share`` (0 to 1) is the largest part of rows without a partition value; beyond it the layer
    is written without partitions, as one folder would hold most of it. Rows are then written once; else
    they are written flat to be counted, and from there by partition.

    ``rebalance`` shuffles a partitioned write by its partition column once more: adaptive execution
    merges small partitions and splits one that holds much of the data over many tasks, each writing
    its own file. Leave it off for a column of few values, where tasks write files of useful size
    anyhow. Without adaptive execution nothing would be split, so the rows stay where they are.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode!r} is neither overwrite nor append")
    spark, files = df.sparkSession, Files(df.sparkSession)
    partition_cols = resolve_partition(df, partition_by) if partition_by is not None else []
    df = blank_keys_as_null(df)
    schema = df.schema
    before = versions.state(files, target)
    if batch is not None and mode == "append" and batch in before.batches:
        logger.warning("Batch %r is already in %s, skipping the write.", batch, target)
        return WriteResult(ALREADY_THERE, target, tuple(partition_cols), 0)

    def write(rows: DataFrame, folder: str, columns: list[str]) -> None:
        adaptive = spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
        if columns and rebalance and adaptive:
            rows = rows.hint("rebalance", *[F.col(name) for name in columns])
        out = rows.write.option("compression", compression)
        (out.partitionBy(*columns) if columns else out).parquet(folder)

    folder = versions.new_version(target)
    path = versions.place(target, folder)
    made = [folder]
    published = written = False
    try:
        if partition_cols and null_share is not None:
            write(df, path, [])
            df = spark.read.schema(schema).parquet(path)
            partition_cols = _unless_null_heavy(df, partition_cols, null_share)
            written = not partition_cols
            if not written:
                folder = versions.new_version(target)
                path = versions.place(target, folder)
                made.append(folder)
        _same_layout(before, partition_cols, mode, partition_overwrite)
        if not written:
            write(df, path, partition_cols)
        count = spark.read.schema(schema).parquet(path).count()
        if not count and guard:
            logger.warning("No rows for %s, skipping the write.", target)
            return WriteResult(SKIPPED_EMPTY, target, tuple(partition_cols), 0)
        names = versions.partition_folders(files, path) if partition_cols else [versions.WHOLE]
        new = {name: [folder] for name in names}
        batches = {}
        if mode == "append":
            held = before.partitions
            new = {**held, **{name: [*held.get(name, []), folder] for name in names}}
            batches = {**before.batches, **({batch: folder} if batch is not None else {})}
        elif partition_overwrite == "dynamic" and partition_cols:
            new = {**before.partitions, **new}
        after = versions.commit(files, target, before, new, batches, notes)
        published = True
        versions.clean(files, target, [before, after])
    finally:
        if not published:
            for name, _ in files.list(target):
                if name in made or name.startswith("_staging-"):
                    files.delete(versions.place(target, name))
            if not files.list(target):
                files.delete(target)
    logger.info("Wrote %s", target)
    return WriteResult(WRITTEN, target, tuple(partition_cols), count)


def _same_layout(before: versions.Commit, partition_cols: list[str], mode: str, partition_overwrite: str) -> None:
    """What stays of the old layer must be partitioned as the new rows are."""
    if mode == "overwrite" and (partition_overwrite == "static" or not partition_cols):
        return
    for name in before.partitions:
        column = name.partition("=")[0]
        if ([column] if column else []) != partition_cols:
            raise ValueError(f"the layer is partitioned by {column or 'nothing'}, not by {partition_cols}")


def _unless_null_heavy(df: DataFrame, partition_cols: list[str], null_share: float) -> list[str]:
    """The partition columns, or none if too many rows have no value there. Reads that column alone."""
    (name,) = partition_cols
    total, nulls, values = df.agg(
        F.count(F.lit(1)), F.count_if(F.col(name).isNull()), F.approx_count_distinct(name)
    ).first()
    if nulls <= null_share * total:
        return partition_cols
    logger.warning(
        "%d of %d rows have no %s (about %d values), writing without partitions.", nulls, total, name, values
    )
    return []


def compact_layer(spark: SparkSession, target: str, schema: StructType, **settings) -> WriteResult:
    """Write a layer anew from itself, so that each partition lies in one folder."""
    return write_layer(read_layer(spark, target, schema), target, **settings)


def append_layer(df: DataFrame, target: str, *, batch: str | None = None) -> WriteResult:
    """Add ``df`` to the target as snappy Parquet, without a guard.

    With a ``batch`` name a rerun adds nothing, and a write that is killed leaves nothing that readers
    see. Without one the files are added in place and a rerun adds its rows again.
    """
    if batch is not None:
        return write_layer(df, target, mode="append", guard=False, batch=batch)
    found = versions.state(Files(df.sparkSession), target).partitions.get(versions.WHOLE)
    folder = versions.place(target, found[-1]) if found else target
    blank_keys_as_null(df).write.mode("append").option("compression", "snappy").parquet(folder)
    return WriteResult(WRITTEN, target)
