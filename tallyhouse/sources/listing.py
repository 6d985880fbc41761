"""Listing files below a prefix as a distributed scan.

A data source whose partitions are prefixes. The driver lists the upper levels
until there are prefixes enough; executors list what is below them, and send
rows in batches. Only names, sizes and times are asked for.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The driver lists level by level until it has this many prefixes to deal out.
PREFIXES = 64
BATCH_ROWS = 8192
SCHEMA = "name string, type string, size bigint, last_modified timestamp"
ARROW = pa.schema([("name", pa.string()), ("type", pa.string()), ("size", pa.int64()), ("last_modified", pa.timestamp("us", "UTC"))])


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, or of a local one without a scheme, and the path in it."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path.removeprefix("file:")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def shown(info: fs.FileInfo) -> bool:
    """Names that Spark's readers skip are not listed."""
    return info.type != fs.FileType.NotFound and (not info.base_name.startswith(("_", ".")) or info.base_name.startswith("_") and "=" in info.base_name)


def level(files: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """What lies directly in a folder, and nothing below it."""
    return [i for i in files.get_file_info(fs.FileSelector(folder, recursive=False)) if shown(i)]


class Prefix(InputPartition):
    """A folder to list; ``deep`` with all that is below it, else files only."""

    def __init__(self, folder: str, deep: bool):
        super().__init__(folder)
        self.folder, self.deep = folder, deep


class ListingReader(DataSourceReader):
    def __init__(self, path: str, recursive: bool, prefixes: int):
        self.path, self.recursive, self.prefixes = path, recursive, prefixes

    def partitions(self) -> list[InputPartition]:
        """Without recursion one prefix, which is listed by the executor that gets it. Otherwise folders are opened
        level by level, the shallowest first, until there are enough of them or none is left to open."""
        files, root = opened(self.path)
        root = root.rstrip("/") or "/"
        if not self.recursive:
            return [Prefix(root, False)]
        opened_up, closed = [], [root]
        while closed and len(closed) < self.prefixes:
            below = []
            for folder in closed:
                opened_up.append(Prefix(folder, False))
                below += [i.path for i in level(files, folder) if i.type == fs.FileType.Directory]
            closed = below
        return [*opened_up, *(Prefix(folder, True) for folder in closed)]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        files, root = opened(self.path)
        root = root.rstrip("/") or "/"
        start = len(root.rstrip("/")) + 1
        rows: list[tuple] = []
        waiting = [partition.folder]
        while waiting:
            folder = waiting.pop()
            for info in level(files, folder):
                name = info.path[start:]
                if info.type == fs.FileType.Directory:
                    if "/" not in name:
                        rows.append((name, "folder", None, None))
                    if partition.deep:
                        waiting.append(info.path)
                else:
                    rows.append((name, "file", info.size, info.mtime))
                if len(rows) >= BATCH_ROWS:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), ARROW)], schema=ARROW)


class ListingSource(DataSource):
    """``spark.read.format("file_listing").option("path", ...)``, after ``spark.dataSource.register(ListingSource)``."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        options = self.options
        return ListingReader(options["path"], options.get("recursive", "false").lower() == "true", int(options.get("prefixes", PREFIXES)))


def scan_files(spark: SparkSession, path: str, recursive: bool = False, prefixes: int = PREFIXES) -> DataFrame:
    """Files and first-level folders below ``path``: name, type, size, last_modified, listed by executors.

    Without ``recursive`` nothing below the first level is asked for. With it
    there are the files of all levels, named from ``path`` on, and the folders
    of the first; folders without files are listed too. The file system has to
    be one that ``pyarrow.fs`` opens by its address.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package
    spark.dataSource.register(ListingSource)
    options = {"path": path, "recursive": str(recursive).lower(), "prefixes": str(prefixes)}
    return spark.read.format("file_listing").options(**options).load()
