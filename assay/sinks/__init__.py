from assay.sinks.bronze import land_bronze
from assay.sinks.catalog import register_table
from assay.sinks.layers import (
    ALREADY_THERE,
    SKIPPED_EMPTY,
    WRITTEN,
    WriteResult,
    append_layer,
    compact_layer,
    resolve_partition,
    staging_folder,
    write_layer,
)

__all__ = [
    "ALREADY_THERE",
    "SKIPPED_EMPTY",
    "WRITTEN",
    "WriteResult",
    "append_layer",
    "compact_layer",
    "land_bronze",
    "register_table",
    "resolve_partition",
    "staging_folder",
    "write_layer",
]
