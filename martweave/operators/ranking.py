"""Ranks and incentives of sales people within a store and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martweave.contract import INCENTIVE_RATE
from martweave.functions.sales import incentive
from martweave.operators.totals import join_null_safe
from martweave.workspace import as_table

GROUP = ["store_id", "sales_month"]

# Rows of one group that a single task may sort.
GROUP_ROW_LIMIT = 1_000_000


def pay_best_sellers(totals: DataFrame, rate: str = INCENTIVE_RATE, group: list[str] = GROUP) -> DataFrame:
    """Adds ``incentive``: a share of the total for rank 1 of its group, else 0.

    Rank 1 holds exactly when the total equals the group's maximum, so a
    maximum (partial before the shuffle) replaces the sorted window.
    """
    best = totals.groupBy(*group).agg(F.max("total_sales").alias("best"))
    paid = incentive(F.col("total_sales"), F.col("best"), rate)
    return join_null_safe(totals, best, group).withColumn("incentive", paid).drop("best")


def rank_sellers(totals: DataFrame, group_row_limit: int = GROUP_ROW_LIMIT) -> DataFrame:
    """Adds ``rnk``: 1 for the highest total, ties share a rank, NULL ranks last.

    The totals are written once. If the largest group is small enough for one
    task a plain window ranks them, otherwise the groups are split by value.
    """
    totals = as_table(totals, "totals")
    sizes = totals.groupBy(*GROUP).count().agg(F.max("count"), F.sum("count"))
    largest, rows = (value or 0 for value in sizes.first())
    if largest > group_row_limit:
        return _rank_split(totals, pieces=max(2, -(-rows // group_row_limit)))
    by_total = Window.partitionBy(*GROUP).orderBy(F.desc("total_sales"))
    return totals.withColumn("rnk", F.rank().over(by_total).cast("bigint"))


def _rank_split(totals: DataFrame, pieces: int) -> DataFrame:
    """Rank over groups of any size.

    Equal totals are counted together, then range-partitioned by group and
    total, so a large group spreads over many partitions in rank order. The
    rank of a total is one, plus the rows above it in its own partition,
    plus the rows of its group in earlier partitions.
    """
    values = totals.groupBy(*GROUP, "total_sales").agg(F.count(F.lit(1)).alias("n"))
    ordered = values.repartitionByRange(pieces, *GROUP, F.desc("total_sales")).withColumn(
        "piece", F.spark_partition_id()
    )
    ordered = as_table(ordered, "pieces")  # they must not change between the two reads below

    before = (Window.unboundedPreceding, -1)
    in_piece = Window.partitionBy(*GROUP, "piece").orderBy(F.desc("total_sales")).rowsBetween(*before)
    of_group = Window.partitionBy(*GROUP).orderBy("piece").rowsBetween(*before)
    above = (
        ordered.groupBy(*GROUP, "piece")
        .agg(F.sum("n").alias("rows"))
        .select(*GROUP, "piece", F.coalesce(F.sum("rows").over(of_group), F.lit(0)).alias("above"))
    )
    local = ordered.withColumn("in_piece", F.coalesce(F.sum("n").over(in_piece), F.lit(0)))
    ranked = join_null_safe(local, above, [*GROUP, "piece"]).select(
        *GROUP, "total_sales", (F.lit(1) + F.col("in_piece") + F.col("above")).cast("bigint").alias("rnk")
    )
    return join_null_safe(totals, ranked, [*GROUP, "total_sales"])
