"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.workspace import as_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settled(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` as a written table; shuffle files that only it needed may go.

    Spark removes the shuffle files of frames that are no longer reachable once
    the driver's collector has seen that, so the collector is asked to look.
    """
    table = as_table(frame, label)
    gc.collect()
    frame.sparkSession._jvm.System.gc()
    return table


def numbered(frame: DataFrame, order: Sequence[Column], group: str | None = None, name: str = "slot") -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... in ``order``, within each value of ``group``.

    A range sort, a small table with the first row of each partition and group,
    and a subtraction: no partition sees a whole group. ``group`` must not be null.
    """
    keys = [F.col(group)] if group else []
    spark = frame.sparkSession
    laid = as_table(
        frame.repartitionByRange(partitions(spark), *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("__at", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("__part", F.shiftright("__at", 33))
    by = [group, "__part"] if group else ["__part"]
    firsts = laid.groupBy(*by).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*by[:-1]).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum("__n").over(earlier)
    starts = firsts.select(*by, "__first", F.coalesce(before, F.lit(0)).alias("__start"))
    return (
        laid.join(starts, by)
        .withColumn(name, F.col("__at") - F.col("__first") + F.col("__start"))
        .select(*frame.columns, name)
    )



def add_column(
    frame: DataFrame,
    name: str,
    kind: T.DataType,
    source: Column | str,
    compute: Callable[[pa.Array], pa.Array],
    step: int = 1 << 23,
    without: Sequence[str] = (),
) -> DataFrame:
    """``frame`` with ``name`` computed from ``source`` by array code, without a shuffle.

    Rows are handed over in slices of at most about ``step`` elements (bytes of
    a text, items of a list; one row may be larger). A column called ``name`` is replaced.
    A ``source`` that is a name is a column of texts, null read as empty: tasks get it once, as it stands
    in the frame. Columns ``without`` do not come back from the tasks.
    """
    rest = frame.drop(name)
    named = isinstance(source, str)
    once = named and rest.columns.count(source) == 1 and isinstance(rest.schema[source].dataType, T.StringType)
    given = rest if once else rest.withColumn("__in", whole_text(source) if named else source)
    at = rest.columns.index(source) if once else len(rest.columns)
    kept = [i for i, c in enumerate(rest.columns) if c not in without]
    schema = T.StructType([*[rest.schema.fields[i] for i in kept], T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            count = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
            ends = np.cumsum(pc.fill_null(count(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            low = 0
            while low < batch.num_rows:
                start = int(ends[low - 1]) if low else 0
                high = max(low + 1, int(np.searchsorted(ends, start + step, side="right")))
                part = batch.slice(low, high - low)
                taken = pc.fill_null(part.column(at), "") if once else part.column(at)
                columns = [*[part.column(i) for i in kept], compute(taken)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                low = high

    return given.mapInArrow(run, schema)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, bool]:
    """``doc_id``, ``raw`` (the text's bytes, null as empty) and ``id``, and whether ids are unique.

    ``id`` is the document id where ids are unique and not null. Otherwise it
    numbers the distinct pairs of id (null last) and text in order, so rows that
    share an id are told apart and rows equal in both share an ``id``.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).cast("binary").alias("raw"))
    known = rows.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if known[0] == known[1]:
        return rows.select("doc_id", "raw", F.col("doc_id").alias("id")), True
    rows = rows.withColumn("digest", F.sha2("raw", 256))
    order = [F.col("doc_id").asc_nulls_last(), F.col("digest")]
    ranks = numbered(rows.select("doc_id", "digest").distinct(), order, name="id")
    ranks = ranks.select(F.col("doc_id").alias("rank_doc"), F.col("digest").alias("rank_digest"), "id")
    same = F.col("doc_id").eqNullSafe(F.col("rank_doc")) & (F.col("digest") == F.col("rank_digest"))
    return rows.join(ranks, same).select("doc_id", "raw", "id"), False


def text_blocks(batches: Iterator[pa.RecordBatch], step: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, concatenated bytes and document ends, for blocks of whole documents of ``id`` and ``raw``."""
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        column = batch.column("raw")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
        low = 0
        while low < len(ids):
            base = int(offsets[low])
            high = max(low + 1, int(np.searchsorted(offsets, base + step, side="right")) - 1)
            yield ids[low:high], data[base : offsets[high]], offsets[low + 1 : high + 1].astype(np.int64) - base
            low = high
