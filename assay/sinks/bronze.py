"""Landing of raw orders."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from assay import landings
from assay.operators import align
from assay.schemas import BRONZE
from assay.sources.bronze import CSV_QUOTING
from assay.workspace import Files

logger = logging.getLogger(__name__)


def run_stamp(moment: dt.datetime | None = None) -> str:
    return (moment or dt.datetime.now(dt.UTC)).strftime("%Y%m%d_%H%M%S")


def _plain_digits(number: Column) -> Column:
    """A floating number as text without an exponent, which whole-number casts do not read.

    Below a thousandth and from 1e20 the usual form stays: no such number is a quantity, and prices
    are read in either form.
    """
    usual = number.cast("string")
    digits = F.regexp_replace(number.try_cast("decimal(38,17)").cast("string"), r"[.]?0+$", "")
    fits = (F.abs(number) >= 1e-3) & (F.abs(number) < 1e20)
    return F.when(usual.contains("E") & fits, digits).otherwise(usual)


def _one_line(name: str) -> Column:
    value = F.col(name)
    broken = value.contains("\n") | value.contains("\r")
    message = F.lit(f"{name} holds a line break; land and read it with multi_line=True")
    return F.when(broken, F.raise_error(message).cast("string")).otherwise(value).alias(name)


def land_bronze(
    df: DataFrame,
    bronze_path: str,
    stamp: str | None = None,
    *,
    multi_line: bool = False,
    batch: str | None = None,
) -> str:
    """Add one ingest run as CSV under ``run=<stamp>`` and return that folder.

    Earlier runs are never overwritten: one of the same second gets a folder of its own. The ledger
    below ``bronze_path`` notes the run before and after it is written (see :mod:`assay.landings`), so
    one that is killed is never read; its text is counted once, for the ledger. ``batch`` names what is
    landed: a batch that has landed is not landed again, and one that was killed is written anew into
    its own folder, so a retry gives its rows once.

    The CSV writer trims values unless told not to. A value with a line break fails the landing, for
    readers would cut its row in two; with ``multi_line`` it is written, to be read with the same setting.
    """
    spark, files = df.sparkSession, Files(df.sparkSession)
    root = bronze_path.rstrip("/")
    name = batch if batch is not None else uuid.uuid4().hex
    started, landed = landings.find(files, root, name) if batch is not None else (None, None)
    if landed is not None:
        logger.warning("Batch %r has landed in %s already.", batch, landed.folder)
        return f"{root}/{landed.folder}"
    if started is not None:
        run = started.folder
        files.delete(f"{root}/{run}")
    else:
        run = f"run={stamp or run_stamp()}"
        if files.exists(f"{root}/{run}"):
            run = f"{run}-{uuid.uuid4().hex[:8]}"
        landings.start(files, root, name, run)
    folder = f"{root}/{run}"
    floating = {
        field.name: _plain_digits(df[field.name])
        for field in df.schema
        if isinstance(field.dataType, (DoubleType, FloatType))
    }
    rows = align(df.withColumns(floating) if floating else df, BRONZE)
    if not multi_line:
        rows = rows.select(*map(_one_line, rows.columns))
    try:
        (
            rows.write.mode("append")
            .options(
                header=True,
                ignoreLeadingWhiteSpace=False,
                ignoreTrailingWhiteSpace=False,
                **CSV_QUOTING,
            )
            .csv(folder)
        )
    except Exception:
        files.delete(folder)
        raise
    written = spark.read.schema(BRONZE).options(header=True, multiLine=multi_line, **CSV_QUOTING).csv(folder)
    sizes = files.lengths(folder)
    landing = landings.Landing(run, tuple(BRONZE.names), written.count(), len(sizes), sum(sizes.values()))
    landings.finish(files, root, name, landing)
    return folder
