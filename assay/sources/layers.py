"""Stored layers, by path or by catalog name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from assay import versions
from assay.operators import align
from assay.sources.bronze import read_bronze_csv
from assay.workspace import Files


def layer_folders(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The folders that hold a layer now, each with the partitions that are read from it."""
    files = Files(spark)
    found = versions.newest_commit(files, path)
    if found is None:
        # Beside plain files a write that was killed may have left folders, which no read may take in.
        found = versions.state(files, path) if versions.has_versions(files, path) else None
    if found is None:
        return {path: [versions.WHOLE]}
    return {versions.place(path, folder): names for folder, names in found.folders().items()}


def read_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet under the declared schema: the newest version of a layer that :func:`write_layer` made,
    or a plain folder of files. A version stays as it is while it is read.

    Declaring the schema skips footer inference, keeps partition values as they were written ('007'
    stays text) and puts the partition column back in its place. Files whose types differ fail the
    read: open them with :func:`read_foreign_layer`.
    """
    files = Files(spark)
    whole, parts = [], []
    for folder, names in layer_folders(spark, path).items():
        beside_versions = folder == path.rstrip("/") and versions.has_versions(files, path)
        if names == [versions.WHOLE]:
            whole.append(f"{folder}/*.parquet" if beside_versions else folder)
        elif names == versions.partition_folders(files, folder) and not beside_versions:
            whole.append(folder)
        else:
            paths = [f"{folder}/{name}" for name in names]
            parts.append(spark.read.schema(schema).option("basePath", folder).parquet(*paths))
    partitioned = [
        folder for folder in whole if "*" not in folder and versions.partition_folders(files, folder)
    ]
    flat = [folder for folder in whole if folder not in partitioned]
    parts += [spark.read.schema(schema).parquet(folder) for folder in partitioned]
    if flat:
        parts.append(spark.read.schema(schema).parquet(*flat))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts).select(*schema.names)


def read_foreign_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet of another writer: the types are those of the files, brought to ``schema`` by name.

    A value that does not fit the declared type is null, such as a ``bigint`` beyond ``int``.
    """
    folders = [folder for folder, _ in layer_folders(spark, path).items()]
    return align(reduce(DataFrame.unionByName, [spark.read.parquet(f) for f in folders]), schema)


def read_table(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """A catalog table or view. Its files are listed anew: a layer may have been rewritten since."""
    spark.catalog.refreshTable(name)
    table = spark.table(name)
    return table if schema is None else table.select(*schema.names)


def is_path(source: str) -> bool:
    return "/" in source


def open_source(spark: SparkSession, source: str | DataFrame, schema: StructType) -> DataFrame:
    """A layer by path if ``source`` holds a slash, else by catalog name; a frame is as it is."""
    if isinstance(source, DataFrame):
        return source
    if is_path(source):
        return read_layer(spark, source, schema)
    return read_table(spark, source, schema)


def open_bronze(
    spark: SparkSession,
    source: str | DataFrame,
    *,
    multi_line: bool = False,
    one_header: bool = False,
) -> DataFrame:
    """Bronze by path, as CSV, or by catalog name; a frame is as it is."""
    if isinstance(source, DataFrame):
        return source
    if is_path(source):
        return read_bronze_csv(spark, source, multi_line=multi_line, one_header=one_header)
    return read_table(spark, source)
