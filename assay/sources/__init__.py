from assay.sources.bronze import find_bronze, header_groups, read_bronze_csv
from assay.sources.generator import fill_orders, generate_orders
from assay.sources.layers import (
    is_path,
    layer_folders,
    open_bronze,
    open_source,
    read_foreign_layer,
    read_layer,
    read_table,
)

__all__ = [
    "fill_orders",
    "find_bronze",
    "generate_orders",
    "header_groups",
    "is_path",
    "layer_folders",
    "open_bronze",
    "open_source",
    "read_bronze_csv",
    "read_foreign_layer",
    "read_layer",
    "read_table",
]
