"""Sharding by longest-processing-time scheduling.

Groups of rows that must stay together (equal texts) are sorted by size and each
goes to the shard with the least load, which a heap gives. The heap runs over
*classes* of equally large groups, not over groups: how many groups of each size
there are is counted on the executors. Sizes below 2^14 are classes of their
own; larger ones share a class when their first 14 binary digits agree, so there
are at most 8192 classes per doubling of the size, some hundred thousand for any
corpus, and loads are off by at most 1 in 8192. Within a class, groups are told
apart by a distributed number, and the class's row says which numbers go where.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martweave.llm.common import numbered, whole_text

ROW_BYTES = 16
_DIGITS = 14


def _level(loads: list[float], size: float, count: int) -> list[int]:
    """How many of ``count`` items of one size each shard has when most of them are dealt.

    The shard with the least load always takes the next item, so all loads rise
    to a common level; the highest level that needs at most ``count`` items is
    found by bisection.
    """

    def need(level: float) -> list[int]:
        return [max(0, -int((load - level) // size)) for load in loads]

    low, high = min(loads), min(loads) + size * (count + 1)
    for _ in range(64):
        middle = (low + high) / 2
        if sum(need(middle)) <= count:
            low = middle
        else:
            high = middle
    return need(low)


def schedule(classes: Iterable[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """For each (class, groups, bytes) from the largest: shards and the running count of groups they take."""
    heap = [(0.0, s) for s in range(shards)]
    plan = []
    for name, count, total in sorted(classes, reverse=True):
        size, left, taken = total / count, count, {}
        if size == 0:
            taken, left = {heap[0][1]: count}, 0
        elif count > 2 * shards:
            given = _level([load for load, _ in heap], size, count)
            heap = [(load + size * g, s) for (load, s), g in zip(heap, given, strict=True)]
            taken = {s: g for (_, s), g in zip(heap, given, strict=True) if g}
            left -= sum(given)
            heapq.heapify(heap)
        for _ in range(left):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            taken[shard] = taken.get(shard, 0) + 1
        ends, run = [], 0
        for shard in sorted(taken):
            run += taken[shard]
            ends.append(run)
        plan.append((name, sorted(taken), ends))
    return plan


def shard_rows(
    frame: DataFrame, shards: int, group: str, size: str, id_col: str = "doc_id", shard_col: str = "shard"
) -> DataFrame:
    """Adds ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless within the shard, by id).

    Rows with an equal ``group`` share a shard; a null ``group`` is a group. A
    hot group is one row of the counting and is split by the join back, but its
    rows do go to one shard, as asked. Sizes must not be negative; null counts
    as 0. Ties are broken by group value. An empty table gives an empty table.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    frame = frame.drop(shard_col, "slot")
    groups = frame.groupBy(F.col(group).alias("__group")).agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias("__bytes"))
    digits = F.length(F.bin("__bytes"))
    scale = F.pow(F.lit(2.0), F.greatest(digits - _DIGITS, F.lit(0))).cast("bigint")
    groups = groups.withColumn("__class", F.col("__bytes") - F.col("__bytes") % scale)
    groups = numbered(groups, [F.col("__group")], "__class", "__number")
    counts = groups.groupBy("__class").agg(F.count(F.lit(1)).alias("n"), F.sum("__bytes").alias("b")).collect()
    plan = schedule(((r["__class"], r["n"], r["b"]) for r in counts), shards)
    spark = frame.sparkSession
    where = spark.createDataFrame(plan, "__class bigint, __shards array<int>, __ends array<bigint>")
    place = F.size(F.filter("__ends", lambda end: end <= F.col("__number"))) + 1
    placed = groups.join(where, "__class").select("__group", F.element_at("__shards", place).alias(shard_col))
    rows = frame.join(placed, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
    return numbered(rows, [F.col(id_col)], shard_col, "slot")


def text_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Id, size in bytes, CRC and digest of each text; null is empty. The text stays behind."""
    raw = whole_text(text_col).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(raw) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.sha2(raw, 256)).alias("text_digest"),
    )
