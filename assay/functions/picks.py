"""Repeatable picks from small domains, the same at any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_pick(row_id: Column, name: str, seed: int, size: int) -> Column:
    """A number in ``[0, size)`` from the first 32 bits of md5(seed|name|row_id)."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(name), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(size)
