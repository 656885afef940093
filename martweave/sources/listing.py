"""Landed files as a table, listed by the executors.

``file_table`` expands the folder tree level by level: every folder is listed by
a task, and names never come to the driver. ``landed_files`` is the same as a data
source for batch and stream reads, whose rows are files. Both show zero-byte files
and hidden CSV files, which Spark's own file sources leave out; hidden folders
belong to writers that are at work and are left alone.

A folder is listed by one call of one task, so a flat folder of very many files is
one task's work.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from martweave.sources.landing import ARROW_SCHEMES, DIRECT_SCHEMES, file_name, list_files, versions
from martweave.workspace import as_table

# (path, is a folder, length, modification time in milliseconds) of what a folder holds.
Entry = tuple[str, bool, int | None, int | None]
Lister = Callable[[str], Iterable[Entry]]

_FOLDERS_PER_TASK = 32
_PLANNED_FOLDERS = 64
_ENTRY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("is_folder", T.BooleanType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified_ms", T.LongType()),
    ]
)


class LandingMissingError(FileNotFoundError):
    """The landing folder does not exist."""


def _arrow_lister() -> Lister:
    """Lists a folder with the Arrow library; all it needs is nested, for executors without this package."""
    schemes = dict(ARROW_SCHEMES)

    def entries(folder: str):
        from pyarrow import fs

        local = folder.removeprefix("file:")
        if local.startswith("/"):
            system, inner = fs.LocalFileSystem(), local
        else:
            scheme, rest = folder.split(":", 1)
            system, inner = fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{rest}")
        for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            modified = None if info.mtime_ns is None else info.mtime_ns // 1_000_000
            yield f"{folder.rstrip('/')}/{info.base_name}", info.type == fs.FileType.Directory, info.size, modified

    return entries


def _shown(entries: Lister) -> Lister:
    """What belongs to a landing: visible folders, visible files, and hidden files that end in ``.csv``."""

    def shown(folder: str):
        for path, is_folder, length, modified in entries(folder):
            name = path.rsplit("/", 1)[-1]
            hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
            if not hidden or (not is_folder and name.endswith(".csv")):
                yield path, is_folder, length, modified

    return shown


def _folder_reader(entries: Lister, rows: int = 8192):
    """A task function from Arrow batches of folders to batches of what they hold."""

    def read(batches):
        import pyarrow as pa

        names = ["path", "is_folder", "length", "modified_ms"]
        types = [pa.string(), pa.bool_(), pa.int64(), pa.int64()]

        def as_batch(held):
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            held = []
            for folder in batch.column("path").to_pylist():
                for entry in entries(folder):
                    held.append(entry)
                    if len(held) == rows:
                        yield as_batch(held)
                        held = []
            if held:
                yield as_batch(held)

    return read


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system's scheme, as paths of landed files begin."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        raise LandingMissingError(f"no landing folder {folder}")
    return system.makeQualified(path).toString()


def as_files(entries: DataFrame) -> DataFrame:
    """``path, file_name, is_csv, length, modified`` of rows with ``path, length, modified_ms``."""
    return entries.select(
        "path",
        file_name(F.col("path")).alias("file_name"),
        F.col("path").endswith(".csv").alias("is_csv"),
        "length",
        F.timestamp_millis("modified_ms").alias("modified"),
    )


def file_table(
    spark: SparkSession, landing: str, direct_schemes=DIRECT_SCHEMES, lister: Lister | None = None
) -> DataFrame:
    """``path, file_name, is_csv, length, modified`` of all files below ``landing``, one row per file.

    One job per level of the tree; a level is a written table, so a lost executor
    repeats its folders only. An empty landing gives no row, a missing one raises
    ``LandingMissingError``; a folder that goes meanwhile holds nothing. File systems
    outside ``direct_schemes`` are listed by Spark in the driver, unless ``lister``
    lists a folder of theirs on an executor.
    """
    root = qualified(spark, landing)
    if lister is None and root.split(":", 1)[0] not in direct_schemes:
        return versions(spark, list_files(spark, landing), direct_schemes)
    read = _folder_reader(_shown(lister or _arrow_lister()))
    frontier = spark.createDataFrame([(root,)], "path string").coalesce(1)
    found = spark.createDataFrame([], _ENTRY_SCHEMA)
    while frontier is not None:
        level = as_table(frontier.mapInArrow(read, _ENTRY_SCHEMA), "listing")
        found = found.unionAll(level.where("NOT is_folder"))
        folders = level.where("is_folder").select("path")
        width = folders.count()
        frontier = folders.repartition(-(-width // _FOLDERS_PER_TASK)) if width else None
    return as_files(found)


class _Folder(InputPartition):
    """A folder for one task: with all below it, or only the files it holds itself."""

    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


def landed_files_source(lister: Lister | None = None) -> type[DataSource]:
    """The data source ``landed_files``; register it by ``spark.dataSource.register``.

    Rows are ``path, length, modified_ms``. Planning looks for folders from the top until it has some
    dozens, and keeps these; tasks walk what is below them. As a stream, a
    micro-batch is one whole listing and its offset the listing's time: what is
    new is for the reader to tell by version, as a modification time says nothing
    about when a file arrived.
    """
    entries = _shown(lister or _arrow_lister())
    schema = "path string, length bigint, modified_ms bigint"

    def planned(root: str) -> list[_Folder]:
        whole, flat = [root], []
        while whole and len(whole) < _PLANNED_FOLDERS:
            below = [path for folder in whole for path, is_folder, _, _ in entries(folder) if is_folder]
            flat += whole
            whole = below
        return [_Folder(p, False) for p in flat] + [_Folder(p, True) for p in whole]

    def walked(partition: _Folder):
        folders = [partition.path]
        while folders:
            for path, is_folder, length, modified in entries(folders.pop()):
                if not is_folder:
                    yield path, length, modified
                elif partition.deep:
                    folders.append(path)

    class Reader(DataSourceReader):
        def __init__(self, root):
            self.root = root

        def partitions(self):
            return planned(self.root)

        def read(self, partition):
            return walked(partition)

    class StreamReader(DataSourceStreamReader):
        def __init__(self, root):
            self.root, self.last = root, 0

        def initialOffset(self):
            return {"listing": 0}

        def latestOffset(self):
            self.last = max(self.last + 1, int(time.time() * 1000))
            return {"listing": self.last}

        def partitions(self, start, end):
            return planned(self.root)

        def read(self, partition):
            return walked(partition)

        def commit(self, end):
            pass

    class LandedFiles(DataSource):
        @classmethod
        def name(cls):
            return "landed_files"

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader(self.options["path"])

        def streamReader(self, schema):
            return StreamReader(self.options["path"])

    return LandedFiles
