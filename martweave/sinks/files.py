"""Parquet outputs: whole tables, partitioned tables and versioned snapshots."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_COLUMN = "run_ts"
SALES_PARTITIONS = ("sales_month", "store_id")
COMPRESSION = "zstd"  # of what is written once and kept


def write_parquet(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    frame.write.mode(mode).parquet(path)


def write_partitioned(frame: DataFrame, path: str, by: tuple[str, ...] = SALES_PARTITIONS) -> None:
    """Replaces the partitions that ``frame`` touches and leaves the others alone.

    Rows are gathered by partition value so that a folder gets few files; a
    folder that holds too many rows for one task is split by AQE.
    """
    with _spread_writers(frame.sparkSession):
        (
            _gathered(frame, by)
            .write.option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .partitionBy(*by)
            .parquet(path)
        )


def drop_partitions(spark: SparkSession, path: str, column: str, values: list[str | None]) -> None:
    """Removes the folders of partitions that have no row any more."""
    for value in values:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_snapshot(frame: DataFrame, path: str, run_ts: int | str, by: tuple[str, ...] = ()) -> None:
    """Writes one version below ``path/run_ts=<run_ts>/``; a repeat replaces that version.

    Reading ``path`` shows all versions with a ``run_ts`` column.
    """
    if not by:
        return frame.write.mode("overwrite").parquet(version_path(path, run_ts))
    with _spread_writers(frame.sparkSession):
        _gathered(frame, by).write.mode("overwrite").partitionBy(*by).parquet(version_path(path, run_ts))


def write_new(
    frame: DataFrame,
    folder: str,
    by: tuple[str, ...] = (),
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    gather: bool = True,
) -> None:
    """Writes a folder that must not exist yet, split by ``by``.

    ``watch`` may add an observation, or columns, to the rows as they go to the writer. Without ``gather``
    each task writes its own rows: no shuffle, and as many files in a folder as tasks have rows for it.
    """
    if not by:
        return watch(frame).write.option("compression", COMPRESSION).parquet(folder)
    if not gather:
        return watch(frame).write.option("compression", COMPRESSION).partitionBy(*by).parquet(folder)
    with _spread_writers(frame.sparkSession):
        watch(_gathered(frame, by)).write.option("compression", COMPRESSION).partitionBy(*by).parquet(folder)


def version_path(path: str, run_ts: int | str) -> str:
    return f"{path}/{RUN_COLUMN}={run_ts}"


def preview(frame: DataFrame, rows: int = 20, enabled: bool = False) -> None:
    """Prints schema and first rows when asked to; off by default, as it costs a job."""
    if enabled:
        frame.printSchema()
        frame.show(rows)


def _gathered(frame: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return frame.hint("rebalance", *[F.col(c) for c in by])


@contextmanager
def _spread_writers(spark: SparkSession):
    """Keeps small data with many folders on all cores.

    AQE would merge a few megabytes into one task, which then creates every
    folder one after the other. Rows of a folder share a partition, so without
    merging there are no more files; a folder that is too large is still split.
    """
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
