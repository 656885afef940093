"""Equi-joins whose hot keys are dealt over many tasks.

A key is hot when it holds at least half of what a task gets on average. Its
rows on the left are dealt over salts, its rows on the right are repeated once
per salt, and the join is made on key and salt; all other keys have salt 0. At
most twice as many keys as tasks can be hot, and the salts add up to a small
multiple of the tasks, so the table of hot keys may be broadcast and the right
side hardly grows, whatever the data.

Which keys are hot is known from counts, or from one pass with a
frequent-items sketch. An error of the sketch costs balance, never a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.workspace import as_table

CHUNKS = 8  # salts of a key that holds as many rows as a task gets on average
TRACKED, MOST_TRACKED = 10_000, 1_000_000  # keys a sketch keeps: at least, and the most Spark allows


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _only_hot(counted: DataFrame, tasks: int) -> DataFrame:
    """``(key0, key1 ..., salts)`` of the hot rows of ``(key0, key1 ..., held, rows)``."""
    keys = [c for c in counted.columns if c.startswith("key")]
    share = F.col("held") * tasks / F.col("rows")
    return counted.where(share >= 0.5).select(*keys, F.ceil(share * CHUNKS).cast("int").alias("salts"))


def hot_of_counts(counts: DataFrame, keys: Sequence[str], held: str, rows: int, tasks: int | None = None) -> DataFrame:
    """Hot keys among ``counts``: one row per key, ``held`` of a total of ``rows``.

    ``counts`` is read by each join that uses the result, so it should be a written table.
    """
    named = [F.col(k).alias(f"key{i}") for i, k in enumerate(keys)]
    counted = counts.select(*named, F.col(held).alias("held"), F.lit(max(rows, 1)).alias("rows"))
    return _only_hot(counted, tasks or shuffle_tasks(counts.sparkSession))


def hot_keys(frame: DataFrame, keys: Sequence[str], tasks: int | None = None) -> dict[str, DataFrame]:
    """For each column of ``keys`` its hot keys, from one pass over these columns.

    NULL is never hot: an inner join drops it before the shuffle. An empty frame has no hot keys.
    """
    tasks = tasks or shuffle_tasks(frame.sparkSession)
    most = min(2 * tasks + 1, MOST_TRACKED)  # NULL may be one of them
    tracked = min(max(TRACKED, 8 * most), MOST_TRACKED)
    top = [F.call_function("approx_top_k", F.col(k), F.lit(most), F.lit(tracked)).alias(f"top{i}") for i, k in enumerate(keys)]
    found = as_table(frame.agg(F.count(F.lit(1)).alias("rows"), *top), "hot-keys")
    hot = {}
    for i, key in enumerate(keys):
        counted = found.select("rows", F.explode(f"top{i}").alias("top")).select(
            F.col("top.item").alias("key0"), F.col("top.count").alias("held"), "rows"
        )
        hot[key] = _only_hot(counted.where(F.col("key0").isNotNull()), tasks)
    return hot


def _with_salts(frame: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """``frame`` with ``__salts``: the number of salts of its key, 1 unless it is hot."""
    named = hot.select(*[F.col(f"key{i}").alias(f"__key{i}") for i in range(len(keys))], F.col("salts").alias("__found"))
    same = [F.col(k) == F.col(f"__key{i}") for i, k in enumerate(keys)]
    joined = frame.join(F.broadcast(named), same, "left")
    return joined.withColumn("__salts", F.coalesce("__found", F.lit(1))).drop("__found", *[f"__key{i}" for i in range(len(keys))])


def join_spread(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    hot: DataFrame,
    spread: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Inner join of ``left`` and ``right``, all columns of both; no name may be on both sides.

    ``hot`` holds the hot keys of ``left``. ``spread`` (all its columns by default) deals
    the rows of a hot key: a hash, so that a repeated task deals them alike. Rows
    equal in ``spread`` stay together; what is left of a hot spot then is a plain
    shuffle, which adaptive execution may split.
    """
    both = set(left.columns) & set(right.columns)
    if both:
        raise ValueError(f"columns on both sides: {sorted(both)}")
    salt = F.pmod(F.xxhash64(*(spread or left.columns)), F.col("__salts")).cast("int")
    dealt = _with_salts(left, left_keys, hot).withColumn("__salt", salt).drop("__salts")
    copies = F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))
    repeated = _with_salts(right, right_keys, hot).withColumn("__copy", copies).drop("__salts")
    on = [F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys)]
    joined = dealt.join(repeated.hint("merge"), [*on, F.col("__salt") == F.col("__copy")], "inner")
    return joined.drop("__salt", "__copy")
