"""Catalog tables over stored layers."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay import versions
from assay.sources.bronze import CSV_QUOTING
from assay.workspace import Files

#: Table property: the commit of the layer that the table's partitions follow.
_COMMIT = "assay.commit"
# Fixed value: the folder of rows without a partition value.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_STATEMENT_PARTITIONS = 500

_CSV_OPTIONS = {"header": "true", "enforceSchema": "false", **CSV_QUOTING}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {row["col_name"]: row["data_type"] for row in rows}


def _same_location(left: str, right: str) -> bool:
    def bare(path: str) -> str:
        return path.removeprefix("file:").rstrip("/").replace("///", "/")

    return bare(left) == bare(right)


def _below(folder: str, path: str) -> bool:
    return _same_location(folder.rstrip("/").rpartition("/")[0], path)


def _single_folders(commit: versions.Commit, path: str, partition_by: str | None) -> dict[str, str]:
    """The one folder of each partition of a versioned layer: a catalog knows no more than one."""
    for name, folders in commit.partitions.items():
        if name.partition("=")[0] != (partition_by or ""):
            raise ValueError(f"{path} is not partitioned by {partition_by}")
        if len(folders) > 1:
            raise ValueError(f"{name or path} lies in several folders; compact the layer first")
    return {name: versions.place(path, folders[0]) for name, folders in commit.partitions.items()}


def _partition(name: str) -> str:
    column, _, value = name.partition("=")
    value = unquote(value)
    return f"PARTITION ({_name(column)} = {'null' if value == _NULL_FOLDER else _text(value)})"


def _follow(
    spark: SparkSession, table: str, path: str, folders: dict[str, str], commit: versions.Commit
) -> None:
    """Bring the partitions of a table to a commit: by what differs from the commit that the table was
    brought to last, which costs two small files and no listing."""
    known = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    last = None
    if known.get(_COMMIT, "").isdigit():
        last = versions.read_commit(Files(spark), path, int(known[_COMMIT]))
    if last is not None:
        shown = {name: versions.place(path, each[0]) for name, each in last.partitions.items()}
    else:
        shown = {row[0]: "" for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    gone = sorted(shown.keys() - folders.keys())
    new = sorted(folders.keys() - shown.keys())
    for at in range(0, len(gone), _STATEMENT_PARTITIONS):
        listed = ", ".join(map(_partition, gone[at : at + _STATEMENT_PARTITIONS]))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")
    for at in range(0, len(new), _STATEMENT_PARTITIONS):
        listed = " ".join(
            f"{_partition(name)} LOCATION {_text(f'{folders[name]}/{name}')}"
            for name in new[at : at + _STATEMENT_PARTITIONS]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {listed}")
    for name in sorted(folders.keys() & shown.keys()):
        if folders[name] != shown[name]:
            place = _text(f"{folders[name]}/{name}")
            spark.sql(f"ALTER TABLE {table} {_partition(name)} SET LOCATION {place}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_COMMIT}' = '{commit.number}')")


def _refuse_files_outside(spark: SparkSession, path: str, column: str) -> None:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    outside = files.filter(~F.col("path").contains(f"/{column}=")).select("path").first()
    if outside is not None:
        raise ValueError(f"{outside[0]} lies in no {column}= folder and would not be shown")


def register_table(
    spark: SparkSession,
    table: str,
    path: str,
    schema: StructType,
    *,
    partition_by: str | None = None,
    file_format: str = "parquet",
    replace: bool = False,
) -> str:
    """Make ``table`` an external table over ``path`` and bring its partitions up to date.

    Call it after every write: the table shows the version that it was registered with, which the next
    write but one deletes. The partitions of a layer that :func:`write_layer` made are brought up by
    difference, from commit to commit; those of plain folders by listing them. A table of that name over
    another place or layout is registered anew only with ``replace``, as its grants and properties are
    lost; one that owns its data is always left alone and refused. A partitioned table shows only what
    lies in partition folders, so files elsewhere below ``path`` are refused as well.
    """
    columns = list(schema)
    if partition_by is not None and partition_by not in schema.names:
        raise ValueError(f"{partition_by} is not a column of {table}")
    commit = versions.newest_commit(Files(spark), path)
    folders = _single_folders(commit, path, partition_by) if commit is not None else {}
    if partition_by is not None and commit is None:
        _refuse_files_outside(spark, path, partition_by)
    location = path if partition_by is not None else folders.get(versions.WHOLE, path)

    if spark.catalog.tableExists(table):
        known = _described(spark, table)
        at = known.get("Location", "")
        if known.get("Type") != "EXTERNAL":
            raise ValueError(f"{table} exists and is not an external table")
        partitions_known = [f.name for f in spark.catalog.listColumns(table) if f.isPartition]
        unchanged = (
            (_same_location(at, path) or (commit is not None and _below(at, path)))
            and {f.name: f.dataType for f in spark.table(table).schema}
            == {f.name: f.dataType for f in columns}
            and partitions_known == ([partition_by] if partition_by else [])
        )
        if not unchanged and not replace:
            raise ValueError(f"{table} is registered over another place or layout; pass replace=True")
        if not unchanged:
            spark.sql(f"DROP TABLE {table}")
        elif not _same_location(at, location):
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(location)}")

    fields = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in columns)
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING {file_format}"
    if file_format == "csv":
        options = ", ".join(f"{key} {_text(value)}" for key, value in _CSV_OPTIONS.items())
        statement += f" OPTIONS ({options})"
    if partition_by is not None:
        statement += f" PARTITIONED BY ({_name(partition_by)})"
    spark.sql(statement + f" LOCATION {_text(location)}")

    if partition_by is not None and commit is not None:
        _follow(spark, table, path, folders, commit)
    elif partition_by is not None:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return table
