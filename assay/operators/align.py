"""Bring a drifted source to a declared schema, by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def align(df: DataFrame, schema: StructType, *, enforce_types: bool = True) -> DataFrame:
    """Columns of ``schema``, in its order and spelling; missing ones null, extra ones dropped.

    Names match exactly or else by case-insensitive spelling. With ``enforce_types=False`` present
    columns keep the type they have, for a caller that casts them with more care.
    """
    by_lower: dict[str, str] = {}
    for name in df.columns:
        by_lower.setdefault(name.lower(), name)

    selected = []
    for field in schema:
        found = field.name if field.name in df.columns else by_lower.get(field.name.lower())
        if found is None:
            column = F.lit(None).cast(field.dataType)
        elif enforce_types and df.schema[found].dataType != field.dataType:
            column = _quoted(found).try_cast(field.dataType)
        else:
            column = _quoted(found)
        selected.append(column.alias(field.name))
    return df.select(*selected)
