"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


@cache
def _single_machine_folder() -> str:
    folder = tempfile.mkdtemp(prefix="assay-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_base(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Every node must see it, so a temporary folder of this machine serves only in local mode.
    """
    base = spark.conf.get(SHARED_FOLDER, None)
    if base:
        return base.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _single_machine_folder()
    raise RuntimeError(f"set {SHARED_FOLDER} to a folder that all nodes share")


class Files:
    """A few file operations on whatever store a path is in."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        found = self._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self._conf), found

    def exists(self, path: str) -> bool:
        store, found = self._open(path)
        return store.exists(found)

    def make(self, path: str, *, until_exit: bool = False) -> None:
        store, found = self._open(path)
        store.mkdirs(found)
        if until_exit:
            store.deleteOnExit(found)

    def delete(self, path: str) -> None:
        store, found = self._open(path)
        store.delete(found, True)

    def list(self, path: str) -> list[tuple[str, bool]]:
        """Names directly below a path, and whether each is a folder; none if nothing is there."""
        store, found = self._open(path)
        if not store.exists(found):
            return []
        return [(s.getPath().getName(), s.isDirectory()) for s in store.listStatus(found)]

    def lengths(self, path: str) -> dict[str, int]:
        """The files directly below a path that are not hidden, with their bytes."""
        store, found = self._open(path)
        below = [(s.getPath().getName(), s) for s in store.listStatus(found) if not s.isDirectory()]
        return {name: s.getLen() for name, s in below if name[0] not in "_."}

    def qualified(self, path: str) -> str:
        """A path with its store's name."""
        store, found = self._open(path)
        return found.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()

    def head(self, path: str, size: int) -> bytes:
        """The first ``size`` bytes of a file, unpacked if its name says that it is compressed."""
        store, found = self._open(path)
        codec = self._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self._conf).getCodec(found)
        stream = store.open(found)
        try:
            return bytes((codec.createInputStream(stream) if codec is not None else stream).readNBytes(size))
        finally:
            stream.close()

    def read(self, path: str) -> str | None:
        """A small file's text."""
        store, found = self._open(path)
        if not store.exists(found):
            return None
        stream = store.open(found)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Make a small file, unless there is one of that name."""
        store, found = self._open(path)
        store.mkdirs(found.getParent())
        if not store.createNewFile(found):
            return False
        stream = store.create(found, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def move(self, source: str, target: str) -> None:
        store, found = self._open(source)
        _, place = self._open(target)
        if place.getParent() is not None:
            store.mkdirs(place.getParent())
        if not store.rename(found, place):
            raise OSError(f"{source} could not be moved to {target}")


def new_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, deleted when the driver's JVM ends in good order."""
    folder = f"{shared_base(spark)}/assay-{uuid.uuid4().hex}"
    Files(spark).make(folder, until_exit=True)
    return folder
