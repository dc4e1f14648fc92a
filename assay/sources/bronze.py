"""Raw orders: folders of CSV files with a header line."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from assay import landings
from assay.landings import Landing
from assay.operators import align
from assay.schemas import BRONZE
from assay.workspace import Files

# Quotes inside a quoted field are doubled, on reading and on writing.
CSV_QUOTING = {"quote": '"', "escape": '"'}

Header = tuple[str, ...]


#: Bytes that are read of a file to find its header; more only if the header is longer.
_HEAD_BYTES = 1 << 15
_PROBES = 16


def _first_record(text: str, whole: bool, multi_line: bool) -> list[str] | None:
    """The first record that is not blank; none if it may go on beyond ``text``. Empty without any."""
    if not multi_line:
        lines = re.split(r"\r\n|\n|\r", text)
        for place, line in enumerate(lines):
            if line.strip():
                return next(csv.reader([line])) if whole or place + 1 < len(lines) else None
        return [] if whole else None
    records = csv.reader(io.StringIO(text, newline=""))
    for record in records:
        if any(value.strip() for value in record):
            return record if whole or next(records, None) is not None else None
    return [] if whole else None


def file_header(files: Files, path: str, multi_line: bool = False) -> Header:
    """A file's header from its start alone: blank lines before it are passed over, as Spark does.
    An empty file has none; a header line without any name raises."""
    size = _HEAD_BYTES
    while True:
        raw = files.head(path, size)
        text = raw.decode("utf-8", "replace").removeprefix("\ufeff")
        record = _first_record(text, len(raw) < size, multi_line)
        if record is not None:
            break
        size *= 4
    if record and not any(record):
        raise ValueError(f"{path} has a header without a name")
    return tuple(record)


@dataclass(frozen=True)
class BronzeFiles:
    """What lies below some bronze paths: whole runs by the ledger, other files by their own headers."""

    spark: SparkSession
    paths: tuple[str, ...]
    multi_line: bool
    landed: list[tuple[str, Landing]]
    others: dict[Header, list[str]]
    #: Bytes of each of the other files.
    sizes: dict[str, int]
    #: Whether all that lies below the paths is to be read.
    everything: bool

    def sources(self) -> dict[str, int]:
        """Everything that is read, with its bytes: run folders and other files."""
        return {folder: landing.bytes for folder, landing in self.landed} | self.sizes

    def without(self, sources: Collection[str]) -> BronzeFiles:
        """The same files but for some folders and files."""
        others = {h: [f for f in found if f not in sources] for h, found in self.others.items()}
        return replace(
            self,
            landed=[each for each in self.landed if each[0] not in sources],
            others={header: found for header, found in others.items() if found},
            sizes={path: size for path, size in self.sizes.items() if path not in sources},
            everything=self.everything and not sources,
        )

    def groups(self) -> dict[Header, list[str]]:
        """Folders of whole runs and single other files, by header."""
        out = {header: list(found) for header, found in self.others.items()}
        for folder, landing in self.landed:
            out.setdefault(landing.header, []).append(folder)
        return out

    def _read(self, groups: dict[Header, list[str]], roots: bool) -> DataFrame:
        if not groups:
            return self.spark.createDataFrame([], BRONZE)
        reader = _csv_reader(self.spark, self.multi_line)
        if len(groups) == 1:
            # Names are compared when files are read, so one that has come since cannot slip in.
            ((header, found),) = groups.items()
            reader = reader.options(enforceSchema=len(set(header)) < len(header))
            return align(reader.schema(_text_schema(header)).csv(list(self.paths) if roots else sorted(found)), BRONZE)
        parts = [
            align(reader.schema(_text_schema(header)).csv(sorted(found)), BRONZE)
            for header, found in sorted(groups.items())
        ]
        return reduce(DataFrame.unionByName, parts)

    def frame(self) -> DataFrame:
        return self._read(self.groups(), self.everything)

    def rows(self) -> int:
        """How many rows there are: of whole runs as the ledger has it, of other files counted."""
        known = sum(landing.rows for _, landing in self.landed)
        return known + (self._read(self.others, False).count() if self.others else 0)


def _csv_reader(spark: SparkSession, multi_line: bool):
    return spark.read.options(header=True, recursiveFileLookup=True, multiLine=multi_line, **CSV_QUOTING)


def find_bronze(spark: SparkSession, *paths: str, multi_line: bool = False, heads: bool = True) -> BronzeFiles:
    """The files below each path, at any depth, sorted out without reading their rows.

    Spark lists them, and joins them with the ledger: a run's folder that holds the files and bytes its
    landing noted needs no look; runs that are not whole are left out. Of any other file the start is
    read for its header (unless ``heads`` is off), however long the file is.
    """
    files = Files(spark)
    roots = [files.qualified(path).rstrip("/") for path in paths]
    whole: dict[str, Landing] = {}
    broken: list[str] = []
    for root in roots:
        found, left = landings.ledger(files, root)
        whole |= {f"{root}/{name}": landing for name, landing in found.items()}
        broken += [f"{root}/{name}" for name in left]
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(list(paths))
        .select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "path", F.col("length"))
    )
    rows = [(name, landing.files, landing.bytes) for name, landing in whole.items()]
    noted = spark.createDataFrame(rows, "folder string, files bigint, bytes bigint")
    held = listing.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    as_noted = {row[0] for row in held.join(noted, ["folder", "files", "bytes"]).select("folder").collect()}
    known = spark.createDataFrame([(name,) for name in [*as_noted, *broken]], "folder string")
    sizes = dict(map(tuple, listing.join(known, "folder", "left_anti").select("path", "length").collect()))
    rest = sorted(sizes)
    others: dict[Header, list[str]] = {}
    if heads:
        with ThreadPoolExecutor(_PROBES) as probes:
            headers = probes.map(lambda path: file_header(files, path, multi_line), rest)
            for path, header in zip(rest, headers):
                if header:
                    others.setdefault(header, []).append(path)
    elif rest:
        others[()] = rest
    landed = [(name, whole[name]) for name in sorted(as_noted)]
    return BronzeFiles(spark, paths, multi_line, landed, others, sizes, everything=not broken)


def header_groups(spark: SparkSession, *paths: str, multi_line: bool = False) -> dict[Header, list[str]]:
    """Run folders and files below the paths, at any depth, by their header; empty files are left out."""
    return find_bronze(spark, *paths, multi_line=multi_line).groups()


def _text_schema(header: Header) -> StructType:
    """Text columns of these names; a name that comes again is numbered, as no column may."""
    seen: set[str] = set()
    fields = []
    for place, name in enumerate(header):
        unique = name if name and name.lower() not in seen else f"{name}_{place}"
        seen.add(unique.lower())
        fields.append(StructField(unique, StringType()))
    return StructType(fields)


def read_bronze_csv(
    spark: SparkSession, *paths: str, multi_line: bool = False, one_header: bool = False
) -> DataFrame:
    """All CSV files below each path as bronze: text columns, bound by header name.

    Files lie flat, in ``run=`` folders or in any others. Files that share a header are read together,
    and the groups are united by name: a column that a group lacks is null there, an extra one is
    dropped. Headers come from the ledger of landings, or from the start of a file. With ``one_header``
    the caller vouches that all files of a path share one, and none is looked for. A file with another
    header then fails the read, as does one that comes after the headers were found. Runs that were
    begun and are not whole are not read.
    ``multi_line`` reads line breaks inside quotes, but then a file cannot be split.
    """
    if not paths:
        raise ValueError("no bronze path given")
    if not one_header:
        return find_bronze(spark, *paths, multi_line=multi_line).frame()
    reader = _csv_reader(spark, multi_line).options(enforceSchema=False)
    places: list[str | list[str]] = list(paths)
    if any(landings.ledger(Files(spark), path)[1] for path in paths):
        found = [find_bronze(spark, path, multi_line=multi_line, heads=False) for path in paths]
        places = [sorted(sum(each.groups().values(), [])) for each in found]
    parts = [align(reader.csv(place), BRONZE) for place in places if place]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], BRONZE)
