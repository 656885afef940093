"""Line dedup: drop lines that many documents share.

Every document is split at line ends; a line's key is the line without white
space at its ends and with A-Z lower-cased. Keys are hashed to 128 bits, the
documents of each hash are counted, and lines whose key occurs in too many
documents go, except in the document with the largest id. The text itself is
moved once, to be put together again from the positions that stay.

Only built-in column functions are used. Counting first reduces to one row per
key and document and then to one per key, both with partial sums before the
shuffle, so a line found everywhere is no hot group. The counts also say which
keys are hot when the lines meet their counts again: those lines are dealt over
many tasks by document and position. The last join is on documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.llm.common import settled, whole_text
from martweave.operators.hot_join import hot_of_counts, join_spread

MIN_DOCS = 3
MIN_CHARS = 20
# The white space that counts at the ends of a line, the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def dedup_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the shared lines dropped from ``text_col``.

    Adds ``n_lines`` (before dropping) and ``n_dropped``, replacing columns of
    those names; all other columns stay. A null text counts as one empty line
    and becomes an empty text. A document is an id: rows that repeat an id count
    once towards ``min_docs``, and each keeps its own lines. A null id is one
    document that is smaller than all others. Keys shorter than ``min_chars``
    code points never go. An empty table gives an empty table.
    """
    docs = docs.withColumn(text_col, whole_text(text_col)).withColumn("__text_hash", F.xxhash64(text_col))
    lines = (
        docs.select(
            F.col(id_col).alias("id"), "__text_hash", F.posexplode(F.split(text_col, "\n")).alias("pos", "line")
        )
        .withColumn("key", line_key(F.col("line")))
        .where(F.length("key") >= min_chars)
        .select("id", "__text_hash", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))
    )
    shared = settled(
        lines.groupBy("k1", "k2", "id")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper"), F.sum("times").alias("times"))
        .where(F.col("n") >= min_docs)
        .select(F.col("k1").alias("s1"), F.col("k2").alias("s2"), "keeper", "times"),
        "shared-lines",
    )
    hot = hot_of_counts(shared, ["s1", "s2"], "times", shared.agg(F.sum("times")).first()[0] or 0)
    found = shared.drop("times")
    gone = (
        join_spread(lines, found, ["k1", "k2"], ["s1", "s2"], hot, ["id", "__text_hash", "pos"])
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias("__id"), F.col("__text_hash").alias("__hash"))
        .agg(F.collect_set("pos").alias("__gone"))
    )
    joined = docs.join(
        gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left"
    ).withColumn("__lines", F.split(text_col, "\n"))
    n_lines = F.size("__lines")
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("__gone"))
    kept = F.array_join(F.transform(stay, lambda p: F.element_at("__lines", p + 1)), "\n")
    return (
        joined.withColumn("n_lines", n_lines.cast("bigint"))
        .withColumn("n_dropped", F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("bigint"))
        .withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept))
        .drop("__text_hash", "__id", "__hash", "__gone", "__lines")
    )
