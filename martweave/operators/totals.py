"""Monthly totals per customer and per sales person.

The total of a mart row belongs to its *key* (customer and month; store, sales
person and month), while the row also shows names. When a dimension holds two
names for one key, each name gets a row and both carry the combined total.

No window is used, so no group has to fit one task: sums are partial
before the shuffle, and totals are joined back to the names. Rows are grouped
by the month's first day, a four-byte key; its text is made from the result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.contract import MONEY_TOTAL
from martweave.functions.sales import full_name, month_key, month_start
from martweave.operators.enrich import Dimensions
from martweave.workspace import as_table

CUSTOMER_KEY = ["customer_id", "sales_date_month"]
SELLER_KEY = ["store_id", "sales_person_id", "sales_month"]
SUM_KEYS = ["customer_id", "store_id", "sales_person_id", "month"]
SUM_VALUES = ["amount", "priced", "sales"]
_TEN_MILLION = 10_000_000


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL matches NULL; keys come from the left."""
    right = right.select(*[F.col(k).alias(f"{k}__r") if k in keys else F.col(k) for k in right.columns])
    on = [left[k].eqNullSafe(right[f"{k}__r"]) for k in keys]
    return left.join(right, on, "inner").drop(*[f"{k}__r" for k in keys])


def totals_of_detail(detail: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """Totals per ``key``, shown once per distinct ``key`` and ``names``.

    The detail is summed once per shown row. These sums are written, and both
    sides of the join read them from there: Spark would prune the two sides
    differently and scan the detail twice.
    """
    shown = as_table(detail.groupBy(*key, *names).agg(F.sum("total_cost").alias("part")), "shown")
    whole = shown.groupBy(*key).agg(F.sum("part").cast(MONEY_TOTAL).alias("total_sales"))
    return join_null_safe(shown.drop("part"), whole, key)


def customer_totals_of_detail(detail: DataFrame) -> DataFrame:
    """Customer monthly mart from the customer detail mart."""
    rows = detail.select(
        "customer_id",
        full_name("first_name", "last_name").alias("full_name"),
        "address",
        "phone_number",
        month_start("sales_date").alias("sales_date_month"),
        "total_cost",
    )
    totals = totals_of_detail(rows, CUSTOMER_KEY, ["full_name", "address", "phone_number"])
    return totals.withColumn("sales_date_month", month_key("sales_date_month"))


def seller_totals_of_detail(detail: DataFrame) -> DataFrame:
    """Sales-person monthly totals from the sales-team detail mart."""
    rows = detail.select(
        "store_id",
        "sales_person_id",
        full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
        month_start("sales_date").alias("sales_month"),
        "total_cost",
    )
    totals = totals_of_detail(rows, SELLER_KEY, ["full_name"])
    return totals.withColumn("sales_month", month_key("sales_month"))


def matched_amounts(fact: DataFrame, dims: Dimensions, summed: bool = False, words: bool = True) -> DataFrame:
    """Amounts of the fact rows that find a partner in all three dimensions.

    ``(customer_id, store_id, sales_person_id, month, amount)``, where ``month`` is
    its first day and an amount counts once per combination of partners, as in
    the joined detail. Only keys and copy counts are joined, never names. Keys that are
    too many to broadcast are looked up by their bits, unless ``words`` is false. When
    these are too many as well, rows are first summed per key
    combination, so the shuffle joins see one row for all sales of a hot key
    combination in a month. Rows that are sums already (``summed``) are not shuffled for that.
    """
    rows = fact.select(
        "customer_id",
        "store_id",
        "sales_person_id",
        month_start("sales_date").alias("month"),
        F.col("total_cost").alias("amount"),
    )
    if not summed and not all(dims.keys_fit(name) or words and dims.words_fit(name) for name in dims.KEYS):
        rows = rows.groupBy("customer_id", "store_id", "sales_person_id", "month").agg(
            F.sum("amount").alias("amount")
        )
    for name in ("store", "sales_team", "customer"):
        rows = dims.matched(name, rows, words)
        if not dims.unique(name):
            rows = rows.withColumn("amount", F.col("amount") * F.col("copies")).drop("copies")
    return rows


def key_sums(sales: DataFrame, *more: str) -> DataFrame:
    """Each sale as a sum by key combination and month (and ``more`` columns) that can be added and taken back.

    ``amount`` is the sum of the known amounts, ``priced`` their number and ``sales`` the number of sales.
    Nothing is shuffled here: :func:`added` makes one row of a key, before its shuffle as far as a task can.
    """
    cost = F.col("total_cost")
    return sales.select(
        *more,
        *SUM_KEYS[:-1],
        month_start("sales_date").alias("month"),
        F.coalesce(cost, F.lit(0)).cast(MONEY_TOTAL).alias("amount"),
        F.when(cost.isNull(), 0).otherwise(1).cast("bigint").alias("priced"),
        F.lit(1).cast("bigint").alias("sales"),
    )


def _sum(amount: str) -> Column:
    """The exact sum of an amount, as sums of its ten millions and of the cents of what is left.

    Two whole numbers are shuffled instead of a decimal of up to 38 digits, which takes more room. Either sum holds nine
    thousand million rows of a key.
    """
    millions = F.sum(F.expr(f"{amount} div {_TEN_MILLION}"))
    cents = F.sum((F.col(amount) % _TEN_MILLION * 100).cast("bigint"))
    whole = millions.cast("decimal(19,0)") * F.lit(_TEN_MILLION)
    return (whole + cents.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast(MONEY_TOTAL)


def negated(sums: DataFrame) -> DataFrame:
    """``sums`` that take back what they hold when they are added."""
    return sums.select(*[(-F.col(c)).alias(c) if c in SUM_VALUES else F.col(c) for c in sums.columns])


def added(sums: DataFrame) -> DataFrame:
    """Several sums of one key as one; keys whose sales have all been taken back go."""
    totals = sums.groupBy(*SUM_KEYS).agg(
        _sum("amount").alias("amount"), F.sum("priced").alias("priced"), F.sum("sales").alias("sales")
    )
    return totals.where("sales > 0")


def sums_as_fact(sums: DataFrame) -> DataFrame:
    """Sums in the shape of sales, for the totals below: one row per key combination and month."""
    return sums.select(
        "customer_id",
        "store_id",
        "sales_person_id",
        F.col("month").alias("sales_date"),
        F.when(F.col("priced") > 0, F.col("amount")).alias("total_cost"),
    )


def customer_totals(fact: DataFrame, dims: Dimensions, summed: bool = False) -> DataFrame:
    """Customer monthly mart straight from fact and dimensions.

    Same rows as ``customer_totals_of_detail`` over the joined detail, but the
    names are joined to the finished totals instead of to every sale. Where sums are joined
    by a shuffle, it deals them by customer as the totals and names need them, so it is kept.
    """
    totals = (
        matched_amounts(fact, dims, summed, words=not summed)
        .groupBy("customer_id", "month")
        .agg(F.sum("amount").cast(MONEY_TOTAL).alias("total_sales"))
        .select("customer_id", month_key("month").alias("sales_date_month"), "total_sales")
    )
    return totals.join(dims.placed("customer", dims.customer_names()), "customer_id")


def seller_key_totals(fact: DataFrame, dims: Dimensions, summed: bool = False) -> DataFrame:
    """Sales-person totals by ``store_id, sales_person_id, month``, without names."""
    return (
        matched_amounts(fact, dims, summed)
        .groupBy("store_id", "sales_person_id", "month")
        .agg(_sum("amount").alias("total_sales"))
    )


def with_seller_names(totals: DataFrame, dims: Dimensions) -> DataFrame:
    """One row per total and name of its sales person; the month becomes text."""
    named = totals.join(dims.placed("sales_team", dims.seller_names()), "sales_person_id")
    return named.withColumn("sales_month", month_key("month")).drop("month")


def seller_totals(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Sales-person monthly totals straight from fact and dimensions."""
    return with_seller_names(seller_key_totals(fact, dims), dims)
