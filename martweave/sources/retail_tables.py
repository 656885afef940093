"""Fact and dimensions in terms of the star-schema tables of a data folder."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.contract import MONEY
from martweave.operators.enrich import Dimensions


class RetailTables:
    """The tables of one folder.

    Each table is opened, and the dimensions are measured, once per instance: a
    frame keeps the file list it was opened with, so the sizes stay true of it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.table = cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))
        self.dimensions = cache(lambda: Dimensions(self.customer(), self.store(), self.sales_team()))

    def sales_fact(self, product_names: bool = False, orders: DataFrame | None = None) -> DataFrame:
        """One row per order line, with the eight sales columns; ``orders`` may stand for the order table.

        The unit price is the line amount over its quantity, rounded down to
        cents. Product names are shown by no mart, so the product table is only
        joined on request; an unknown product keeps its sale. Small tables are
        left to Catalyst's own size-checked broadcast.
        """
        lines, suppliers = self.table("lineitem"), self.table("supplier")
        orders = self.table("orders") if orders is None else orders
        joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
            suppliers, lines.l_suppkey == suppliers.s_suppkey
        )
        product = F.lit(None).cast("string")
        if product_names:
            parts = self.table("part")
            joined = joined.join(parts, lines.l_partkey == parts.p_partkey, "left")
            product = F.col("p_name")
        cents = F.expr(
            "cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) div nullif(cast(l_quantity as bigint), 0)"
        )
        return joined.select(
            F.col("o_custkey").alias("customer_id"),
            F.col("s_nationkey").cast("bigint").alias("store_id"),
            product.alias("product_name"),
            F.col("o_orderdate").cast("date").alias("sales_date"),
            F.col("l_suppkey").alias("sales_person_id"),
            (cents.cast("decimal(18,0)") / 100).cast(MONEY).alias("price"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("total_cost"),
            F.lit(None).cast("string").alias("extra_column"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
        )

    def customer(self) -> DataFrame:
        customer, nation = self.table("customer"), self.table("nation")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            F.col("c_custkey").alias("customer_id"),
            F.substring("c_name", 1, 8).alias("first_name"),
            F.substring("c_name", 10, 9).alias("last_name"),
            F.col("n_name").alias("address"),
            F.col("c_nationkey").cast("string").alias("pincode"),
            F.concat(F.lit("91"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("phone_number"),
        )

    def store(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("id"), F.col("r_name").alias("store_manager_name")
        )

    def sales_team(self) -> DataFrame:
        supplier, nation = self.table("supplier"), self.table("nation")
        return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
            F.col("s_suppkey").alias("id"),
            F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("n_name").alias("address"),
            F.col("s_nationkey").cast("string").alias("pincode"),
            F.col("s_nationkey").alias("manager_id"),
            F.lit("N").alias("is_manager"),
        )


@cache
def open_tables(spark: SparkSession, folder: str) -> RetailTables:
    """The tables of ``folder``, shared by all queries of a session."""
    return RetailTables(spark, folder)
