"""Documents dealt into blocks of bounded size, for work that numpy does on many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.workspace import new_folder

#: Bytes of text that a block holds on average.
BLOCK_BYTES = 4 << 20
#: For a few tasks at least; results are the same at any number.
FEWEST_BLOCKS = 16
#: What a row takes beside its text.
ROW_BYTES = 64


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def block_of(table: pa.Table, rows: int) -> pa.Array:
    block = table.column("block")[0].as_py() if len(table) else 0
    return pa.array(np.full(rows, block, np.int64))


def texts_of(table: pa.Table, *path: str) -> list[str]:
    """The texts at ``path`` inside ``row``; a null one is empty."""
    return [text or "" for text in pc.struct_field(table.column("row"), path).to_pylist()]


def with_row(source: DataFrame, added: str) -> StructType:
    """The schema of ``row``, as it is in ``source``, and of further columns given in DDL."""
    return StructType([source.schema["row"], *StructType.fromDDL(added)])


def blocked(docs: DataFrame, doc_id: Column, text: Column, block_bytes: int) -> DataFrame:
    """``docs`` as ``row``, with the ``id`` and the ``block`` of each. The text travels in ``row`` alone,
    from where :func:`texts_of` takes it.

    Rows of equal id and text share a block, unless all of them would overfill one: then rows are
    stored once under a number of their own, by which copies are spread over blocks. Rows of one id, or
    of none, that differ in their text lie in different blocks, so ids that tie need an order between
    blocks.
    """
    placed = docs.select(
        F.struct("*").alias("row"),
        doc_id.cast("bigint").alias("id"),
        F.xxhash64(doc_id, text).alias("place"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("size"),
    )
    groups = placed.groupBy("place").agg(
        F.sum("size").alias("size"), F.sum(F.col("size") + ROW_BYTES).alias("held")
    )
    size, largest = groups.agg(F.sum("size"), F.max("held")).first()
    blocks = max(FEWEST_BLOCKS, -(-(size or 0) // block_bytes))
    place = F.col("place")
    if (largest or 0) > block_bytes:
        # A number must be the same each time that the rows are read, so they are written with it.
        path = f"{new_folder(docs.sparkSession)}/copies"
        placed.withColumn("copy", F.monotonically_increasing_id()).write.parquet(path)
        placed = docs.sparkSession.read.parquet(path)
        spread = F.pmod(F.xxhash64("copy"), F.lit(-(-largest // block_bytes)))
        place = F.xxhash64("place", spread)
    return placed.select("row", "id", F.pmod(place, F.lit(blocks)).cast("bigint").alias("block"))
