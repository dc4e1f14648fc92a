"""One row per key, always the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StringType, VariantType

_RANK = "__rank"
_HASH = "__key_hash"


def _orderable(data_type: DataType) -> bool:
    return not isinstance(data_type, (MapType, VariantType))


def dedup(
    df: DataFrame, keys: Sequence[str], survivor_order: Sequence[str | Column] = ()
) -> DataFrame:
    """Keep the first row of each key by ``survivor_order``, then by the other columns as they stand.

    Ties can only be between equal rows, so the result does not depend on the partitioning.

    ``rank = 1`` plans as a limit per key on both sides of one shuffle. A key with a third of all rows
    leaves each map task as a single row, so it does not weigh on the reducer. The key's hash leads
    the sort: a number settles nearly every comparison, where ids with a common prefix would not. It has
    32 bits, as it goes through the shuffle with its row. Keys that are not text come before it: rows that
    lie together by such keys are not shuffled, and stay in their order.
    """
    chosen = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in survivor_order]
    named = {*keys, *(c for c in survivor_order if isinstance(c, str))}
    others = [
        F.col(field.name).asc_nulls_last()
        for field in df.schema
        if field.name not in named and _orderable(field.dataType)
    ]
    # A hash may differ between equal keys of other types (collated text, -0.0), so text alone is hashed.
    plain_text = [key for key in keys if df.schema[key].dataType == StringType()]
    hashed = df.withColumn(_HASH, F.hash(*plain_text)) if plain_text else df
    others_first = [key for key in keys if key not in plain_text]
    partition = [*others_first, _HASH, *plain_text] if plain_text else list(keys)
    window = Window.partitionBy(*partition).orderBy(*(chosen + others or [F.lit(0)]))
    return (
        hashed.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK, _HASH)
    )
