"""Incremental pickup of new landing files by Structured Streaming.

The stream only finds new files; each micro-batch is an ordinary batch run. The
checkpoint remembers which files were handed over. A failed micro-batch is
repeated with the same number and the same files, so ``handle`` must be
repeatable; ``run_batch`` is. Numbers start again with every checkpoint, so a run
id needs the checkpoint's id as well: ``run_id_of``.
"""

from __future__ import annotations

from collections.abc import Callable

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from martweave.sources import listing

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def run_id_of(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A run id that no other checkpoint gives: the id that the stream keeps in it, and the number."""
    metadata = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return f"pickup-{json.loads(metadata)['id']}-{batch_id}"


def start_pickup(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    handle: Callable[[list[str], int], None],
    archive: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Calls ``handle(paths, batch_id)`` for the files that are new below ``landing``.

    Handles everything present now and then ends (``availableNow``); start it
    again for the next delivery. Only names are read, never file contents.
    With ``archive`` Spark moves handed-over files there when a *later* batch
    begins, so the last files stay in landing for a while. Zero-byte files hold
    no row and never appear here; ``landing.list_files`` shows them.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
    reader = reader.option("recursiveFileLookup", "true")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def each(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.toLocalIterator())
        if paths:
            handle(paths, batch_id)

    return (
        reader.load(landing)
        .select("path")
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_file_pickup(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    lister: listing.Lister | None = None,
) -> StreamingQuery:
    """Calls ``handle(files, batch_id)`` with the table of files that are new below ``landing``.

    Unlike ``start_pickup`` it sees zero-byte files, hidden CSV files and new versions
    under an old name, tasks list the landing, and the driver holds no path. The table has the
    columns of ``listing.file_table``, which ``run_batch`` takes.

    One call of this is one listing. Beside the checkpoint it keeps the files of the last
    listing with the number of the batch that first saw each version; what is new in
    a batch is read from there, so a batch that is repeated gets the same files.
    A version that leaves the landing is forgotten.
    """
    spark.dataSource.register(listing.landed_files_source(lister))
    seen_at = f"{checkpoint}/landed-files"

    def each(batch: DataFrame, batch_id: int) -> None:
        target = f"{seen_at}/{batch_id}"
        written = _written_batches(spark, seen_at)
        if batch_id not in written:
            now = listing.as_files(batch)
            earlier = [n for n in written if n < batch_id]
            if earlier:
                before = spark.read.parquet(f"{seen_at}/{max(earlier)}").select(
                    F.col("path").alias("seen_path"),
                    F.col("length").alias("seen_length"),
                    F.col("modified").alias("seen_modified"),
                    "first_seen",
                )
                same = (
                    (F.col("path") == F.col("seen_path"))
                    & F.col("length").eqNullSafe(F.col("seen_length"))
                    & F.col("modified").eqNullSafe(F.col("seen_modified"))
                )
                now = now.join(before, same, "left").select(
                    *now.columns, F.coalesce("first_seen", F.lit(batch_id)).cast("bigint").alias("first_seen")
                )
            else:
                now = now.withColumn("first_seen", F.lit(batch_id).cast("bigint"))
            now.write.mode("overwrite").parquet(target)
        new = spark.read.parquet(target).where(F.col("first_seen") == batch_id).drop("first_seen")
        if not new.isEmpty():
            handle(new, batch_id)
        _forget(spark, seen_at, [n for n in written if n < batch_id - 1])

    return (
        spark.readStream.format("landed_files")
        .load(listing.qualified(spark, landing))
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _written_batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches whose table below ``folder`` is complete."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    system = paths(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    done = system.globStatus(paths(folder, "*/_SUCCESS")) or []
    return [int(s.getPath().getParent().getName()) for s in done]


def _forget(spark: SparkSession, folder: str, batches: list[int]) -> None:
    """Removes the tables of batches that cannot be repeated any more."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    system = paths(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for n in batches:
        system.delete(paths(folder, str(n)), True)
