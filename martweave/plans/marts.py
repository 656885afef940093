"""The four marts, as DataFrame to DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martweave.contract import (
    CUSTOMER_DETAIL_COLUMNS,
    CUSTOMER_MONTHLY_COLUMNS,
    INCENTIVE_COLUMNS,
    INCENTIVE_RATE,
    SALES_TEAM_DETAIL_COLUMNS,
)
from martweave.functions.sales import month_key
from martweave.operators.enrich import Dimensions
from martweave.operators.ranking import pay_best_sellers
from martweave.operators.totals import (
    customer_totals,
    customer_totals_of_detail,
    seller_key_totals,
    seller_totals_of_detail,
    with_seller_names,
)


def customer_detail(enriched: DataFrame, *more: str) -> DataFrame:
    """One row per sale with the customer's columns, and ``more``."""
    return enriched.select(*CUSTOMER_DETAIL_COLUMNS, *more)


def sales_team_detail(enriched: DataFrame, *more: str) -> DataFrame:
    """One row per sale with the sales person's columns, the month, and ``more``."""
    return enriched.withColumn("sales_month", month_key("sales_date")).select(*SALES_TEAM_DETAIL_COLUMNS, *more)


def customer_monthly(fact: DataFrame, dims: Dimensions, summed: bool = False) -> DataFrame:
    """``summed``: no two rows of ``fact`` have the same keys and month."""
    return customer_totals(fact, dims, summed).select(*CUSTOMER_MONTHLY_COLUMNS)


def customer_monthly_of_detail(detail: DataFrame) -> DataFrame:
    return customer_totals_of_detail(detail).select(*CUSTOMER_MONTHLY_COLUMNS)


def sales_person_incentive(
    fact: DataFrame, dims: Dimensions, rate: str = INCENTIVE_RATE, summed: bool = False
) -> DataFrame:
    """``summed``: no two rows of ``fact`` have the same keys and month."""
    paid = pay_best_sellers(seller_key_totals(fact, dims, summed), rate, ["store_id", "month"])
    return with_seller_names(paid, dims).select(*INCENTIVE_COLUMNS)


def sales_person_incentive_of_detail(detail: DataFrame, rate: str = INCENTIVE_RATE) -> DataFrame:
    return pay_best_sellers(seller_totals_of_detail(detail), rate).select(*INCENTIVE_COLUMNS)


def only_months(detail: DataFrame, months: DataFrame) -> DataFrame:
    """Rows of the months listed in ``months(sales_month)``.

    The list holds one row per calendar month, so it is collected and becomes a
    literal filter that prunes the month folders of a partitioned detail table.
    """
    keys = [r[0] for r in months.select("sales_month").distinct().collect()]
    wanted = F.col("sales_month").isin([k for k in keys if k is not None])
    return detail.where(wanted | F.col("sales_month").isNull() if None in keys else wanted)
