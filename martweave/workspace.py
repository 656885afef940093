"""Folders for intermediate tables, on storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_fallback: dict[str, str] = {}


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors are one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_base(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="martweave-")
    return _local_fallback[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, empty folder for this application; removed when the driver ends."""
    root = f"{shared_base(spark)}/martweave-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    file_system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(path)
    file_system.deleteOnExit(path)
    return f"{root}/{label}-{uuid.uuid4().hex[:12]}"


def as_table(frame: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``frame`` once and go on from the files, in the session's ``compression`` unless one is given.

    Cuts the lineage and survives the loss of executors, which a cached frame does not.
    """
    spark = frame.sparkSession
    folder = new_folder(spark, label)
    frame.write.parquet(folder, compression=compression)
    return spark.read.schema(frame.schema).parquet(folder)
