"""Landed files: listing, split by extension, header gate.

All functions work on file *metadata* (one row per file). Paths are plain Hadoop
path texts such as ``s3a://bucket/landing/day one.csv``, without URL encoding.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from functools import partial, reduce
from typing import BinaryIO
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.contract import MANDATORY_COLUMNS
from martweave.workspace import as_table

log = logging.getLogger(__name__)

ACCEPTED = "accepted"
REJECTED = "rejected"

NOT_CSV = "not a csv file"
MISSING_COLUMNS = "missing columns"

HIDDEN_NAME = "hidden name, which readers skip"

# Files of these file systems are opened directly to read their first line. Add
# others where the executors can open them: by the Arrow library under the name
# in ARROW_SCHEMES, or by an opener that the caller passes.
DIRECT_SCHEMES = ("file",)
# What the Arrow library calls the file systems that Hadoop names otherwise.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}
Opener = Callable[[str], BinaryIO]

# The CSV reader's own limit.
_MOST_COLUMNS = 20480

_PATHS_PER_TASK = 256
_PATH_SCHEMA = T.StructType([T.StructField("path", T.StringType(), False)])
_VERSION_SCHEMA = "path string, length bigint, modified_ms bigint"
_HEADER_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("header", T.StringType())])


class NoInputError(RuntimeError):
    """Nothing to process: no file, no CSV file, or no file with all columns."""


def plain_path(url: str) -> str:
    """A listed file URL as a Hadoop path: decoded, with one slash for a local root."""
    return unquote(re.sub(r"^([a-z][a-z0-9+.-]*):///", r"\1:/", url))


def metadata_path() -> Column:
    """The row's source file as a plain path, the column form of ``plain_path``."""
    url = F.regexp_replace(F.col("_metadata.file_path"), r"^([a-z][a-z0-9+.-]*):///", "$1:/")
    return F.when(url.contains("%"), F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))).otherwise(url)


def reader_path(path: str) -> str:
    """A plain path with glob characters escaped, for ``spark.read``."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def list_files(spark: SparkSession, landing: str) -> list[str]:
    """All files below ``landing``, zero-byte files and hidden CSV files included.

    The listing Spark makes for any read (names only, no content), and the CSV
    files that it hides because their names begin with ``_`` or ``.``.
    """
    listed = spark.read.option("recursiveFileLookup", "true").text(landing).inputFiles()
    return sorted({*(plain_path(url) for url in listed), *hidden_csv_files(spark, landing)})


def hidden_csv_files(spark: SparkSession, landing: str) -> list[str]:
    """CSV files below ``landing`` whose own name begins with ``_`` or ``.``.

    Hidden folders are left alone: they belong to writers that are at work.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(landing)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    found, folders = [], [root]
    while folders:
        folder = folders.pop()
        names = spark._jvm.org.apache.hadoop.fs.Path(folder, "[_.]*.csv")
        found += [s.getPath().toString() for s in system.globStatus(names) or [] if s.isFile()]
        folders += [
            s.getPath()
            for s in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "*")) or []
            if s.isDirectory() and s.getPath().getName()[0] not in "_."
        ]
    return [plain_path(p) for p in found]


def is_hidden(name: Column) -> Column:
    return name.rlike("^[_.]")


def file_identities(spark: SparkSession, paths: list[str], direct_schemes=DIRECT_SCHEMES) -> DataFrame:
    """``(path, length, modified)``: the version of each file, for telling a new delivery under an old name.

    Tasks look the files up; those of other schemes than the direct ones are listed by Spark, and by the driver
    where Spark leaves them out (zero-byte and hidden files). Contents are not read. Files that are gone are not in it.
    """
    direct = [p for p in paths if p.split(":", 1)[0] in direct_schemes]
    other = sorted(set(paths).difference(direct))
    found = as_file_frame(spark, direct).select("path").mapInArrow(_version_reader(), _VERSION_SCHEMA)
    found = found.select("path", "length", F.timestamp_millis("modified_ms").alias("modified"))
    visible = [p for p in other if p.rsplit("/", 1)[-1][:1] not in ("_", ".")]
    if visible:
        listed = spark.read.format("binaryFile").load([reader_path(p) for p in visible])
        listed = listed.select(metadata_path().alias("path"), "length", F.col("modificationTime").alias("modified"))
        found = found.unionAll(listed)
        empty = as_file_frame(spark, visible).join(listed, "path", "left_anti")
        other = sorted({*other} - {*visible} | {r["path"] for r in empty.select("path").toLocalIterator()})
    if other:
        rows = spark.createDataFrame(_statuses(spark, other), _VERSION_SCHEMA)
        found = found.unionAll(rows.select("path", "length", F.timestamp_millis("modified_ms").alias("modified")))
    return found.dropDuplicates(["path"])


def _statuses(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """``(path, length, modified_ms)`` of files that exist, one look of the driver each."""
    rows = []
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(at):
            status = system.getFileStatus(at)
            rows.append((path, status.getLen(), status.getModificationTime()))
    return rows


def _version_reader():
    """A task function from Arrow batches of paths to batches of (path, length, modified_ms), for files that exist."""
    schemes = dict(ARROW_SCHEMES)

    def info_of(path: str):
        from pyarrow import fs

        local = path.removeprefix("file:")
        if local.startswith("/"):
            return fs.LocalFileSystem().get_file_info(local)
        scheme, rest = path.split(":", 1)
        system, inner = fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{rest}")
        return system.get_file_info(inner)

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            infos = [(path, info_of(path)) for path in batch.column("path").to_pylist()]
            infos = [(path, info) for path, info in infos if info.is_file]
            columns = [
                pa.array([path for path, _ in infos], pa.string()),
                pa.array([info.size for _, info in infos], pa.int64()),
                pa.array([info.mtime_ns // 1_000_000 for _, info in infos], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["path", "length", "modified_ms"])

    return read


def as_file_frame(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, file_name, is_csv)`` of a path list. The suffix test is case-sensitive."""
    files = spark.createDataFrame([(p,) for p in paths], _PATH_SCHEMA)
    tasks = max(1, len(paths) // _PATHS_PER_TASK)
    return files.repartition(tasks).select(
        "path",
        file_name(F.col("path")).alias("file_name"),
        F.col("path").endswith(".csv").alias("is_csv"),
    )


def versions(spark: SparkSession, files: list[str] | DataFrame, direct_schemes=DIRECT_SCHEMES) -> DataFrame:
    """``path, file_name, is_csv, length, modified`` of a path list, or of a file table that has these columns."""
    if isinstance(files, DataFrame):
        return files.select("path", "file_name", "is_csv", "length", "modified")
    return as_file_frame(spark, files).join(file_identities(spark, files, direct_schemes), "path", "left")


def _header_reader(chunk_bytes: int = 1 << 16, opener: Opener | None = None):
    """A task function from Arrow batches of paths to batches of (path, header).

    Everything it needs is nested, so it reaches executors that do not have this
    package installed.
    """
    schemes = dict(ARROW_SCHEMES)

    def first_line(stream) -> str | None:
        """The first line that is not blank, read in small chunks; None when there is none.

        Each chunk is searched once for line ends, and a long line is joined once.
        """
        parts, begun = [], False
        while True:
            chunk = stream.read(chunk_bytes)
            if chunk and not begun:
                chunk, begun = chunk.removeprefix(b"\xef\xbb\xbf"), True
            *whole, rest = chunk.replace(b"\r", b"\n").split(b"\n") if chunk else (b"", b"")
            for line in whole:
                line = b"".join([*parts, line])
                parts = []
                if line.strip(bytes(range(33))):
                    return line.decode("utf-8", "replace")
            if not chunk:
                return None
            parts.append(rest)

    def open_directly(path: str):
        from pyarrow import fs

        local = path.removeprefix("file:")
        if local.startswith("/"):
            return fs.LocalFileSystem().open_input_stream(local, compression=None)
        scheme, rest = path.split(":", 1)
        system, inner = fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{rest}")
        return system.open_input_stream(inner, compression=None)

    def header_of(path: str) -> str | None:
        with (opener or open_directly)(path) as stream:
            return first_line(stream)

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            paths = batch.column("path").to_pylist()
            headers = pa.array([header_of(path) for path in paths], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), headers], ["path", "header"])

    return read


def _scan_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """First lines by a text scan. Works on every file system, but reads the files whole."""
    lines = (
        spark.read.text([reader_path(p) for p in paths])
        .where(F.col("_metadata.file_block_start") == 0)
        .where(F.col("value").rlike(r"[^\x00-\x20]"))
        .select(metadata_path().alias("path"), "value", F.monotonically_increasing_id().alias("position"))
    )
    return lines.groupBy("path").agg(F.min_by("value", "position").alias("header"))


def read_headers(
    spark: SparkSession, files: list[str] | DataFrame, direct_schemes=DIRECT_SCHEMES, opener: Opener | None = None
) -> DataFrame:
    """``(path, header)``: the first line of each file, NULL when it has none.

    One job for all files, a path list or a table with their ``path``. With a directly
    readable file system, tasks open their share of the files and stop after the
    first line; the data are not scanned, and no path comes to the driver.
    ``opener`` opens a path of the direct schemes on an executor. Files of other
    schemes are scanned whole, which is logged.
    """
    paths = files.select("path") if isinstance(files, DataFrame) else as_file_frame(spark, files).select("path")
    is_direct = F.split_part("path", F.lit(":"), F.lit(1)).isin(list(direct_schemes))
    direct = paths.where(is_direct)
    tasks = max(1, direct.count() // _PATHS_PER_TASK)
    headers = direct.repartition(tasks).mapInArrow(_header_reader(opener=opener), _HEADER_SCHEMA)
    other = [r[0] for r in paths.where(~is_direct).toLocalIterator()]  # Spark's scan takes a list
    if not other:
        return headers
    log.warning("%d files are read whole for their headers; see direct_schemes", len(other))
    return headers.unionAll(_scan_headers(spark, other))


def header_columns(spark: SparkSession, headers: list[str]) -> DataFrame:
    """``(header, columns)``: column names as Spark's CSV reader sees them.

    One call per *distinct* header line, however many files share it.
    """
    read = partial(spark.read.csv, header=True)
    rows = [(h, read(spark.sparkContext.parallelize([h], 1)).columns) for h in headers]
    return spark.createDataFrame(rows, "header string, columns array<string>")


def junk_columns(headers: DataFrame) -> DataFrame:
    """``(header, columns)`` of ``headers(header)`` that cannot be accepted, in one distributed step.

    Spark's CSV parser splits them. Names are made unique as its reader does: a
    blank one becomes ``_c`` and its position, a repeated one gets its position.
    """
    commas = F.length("header") - F.length(F.replace("header", F.lit(","))) + 1
    widest = headers.agg(F.max(commas)).first()[0]
    names = [f"c{i}" for i in range(min(int(widest or 1), _MOST_COLUMNS))]
    cells = F.from_csv("header", ", ".join(f"{n} string" for n in names))
    given = headers.withColumn("cells", cells).select(
        "header", F.slice(F.array(*[F.col(f"cells.{n}") for n in names]), F.lit(1), commas).alias("given")
    )

    def unique(name: Column, at: Column) -> Column:
        again = F.size(F.filter("given", lambda other: F.lower(other) == F.lower(name))) > 1
        return (
            F.when(name.isNull() | (name == ""), F.concat(F.lit("_c"), at.cast("string")))
            .when(again, F.concat(name, at.cast("string")))
            .otherwise(name)
        )

    return given.select("header", F.transform("given", unique).alias("columns"))


def check_files(
    spark: SparkSession,
    files: list[str] | DataFrame,
    direct_schemes=DIRECT_SCHEMES,
    require_csv: bool = True,
    opener: Opener | None = None,
) -> DataFrame:
    """The verdict table, one row per file of a path list or a file table (:func:`versions`).

    ``path, file_name, header, columns, missing, extras, verdict, reason``, and the
    file's version: ``length, modified``. A file is accepted when its name ends in
    ``.csv`` and is not hidden, and its header holds every mandatory column,
    compared case-sensitively; extra columns are allowed. Raises ``NoInputError``
    without any file, and with ``require_csv`` without any CSV file.
    """
    if isinstance(files, list) and not files:
        raise NoInputError("no data available to process")
    landed = as_table(versions(spark, files, direct_schemes).dropDuplicates(["path"]), "landed")
    hidden = is_hidden(F.col("file_name"))
    readable = F.col("is_csv") & ~hidden
    count, csv_count = landed.agg(F.count(F.lit(1)), F.count_if(readable)).first()
    if not count:
        raise NoInputError("no data available to process")
    if require_csv and not csv_count:
        raise NoInputError("no CSV files to process")
    headers = as_table(read_headers(spark, landed.where(readable), direct_schemes, opener), "headers")
    distinct = headers.where("header is not null").select("header").distinct()
    # Only headers that may be complete are parsed one by one; there are few, as each is a table shape.
    complete = reduce(lambda a, b: a & b, [F.contains("header", F.lit(c)) for c in MANDATORY_COLUMNS])
    parsed = header_columns(spark, [r[0] for r in distinct.where(complete).collect()]).unionByName(
        junk_columns(distinct.where(~complete))
    )
    required = F.array(*[F.lit(c) for c in MANDATORY_COLUMNS])
    found = F.coalesce(F.col("columns"), F.array().cast("array<string>"))
    accepted = readable & (F.size("missing") == 0)
    return (
        landed.join(headers, "path", "left")
        .join(parsed, "header", "left")
        .withColumn("missing", F.array_except(required, found))
        .withColumn("extras", F.array_except(found, required))
        .select(
            "path",
            "file_name",
            "header",
            "columns",
            "missing",
            "extras",
            F.when(accepted, ACCEPTED).otherwise(REJECTED).alias("verdict"),
            F.when(~F.col("is_csv"), NOT_CSV)
            .when(hidden, HIDDEN_NAME)
            .when(F.size("missing") > 0, MISSING_COLUMNS)
            .alias("reason"),
            "length",
            "modified",
        )
    )


def require_accepted(verdicts: DataFrame) -> DataFrame:
    """The accepted files; ``NoInputError`` when there is none."""
    accepted = verdicts.where(F.col("verdict") == ACCEPTED)
    if accepted.isEmpty():
        raise NoInputError("no file with all mandatory columns")
    return accepted
