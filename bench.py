"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then REPEATS times into a sink that discards
the rows; the median counts. ``window_form`` times the same two monthly marts in
the direct formulation (sum over a window on the joined detail, then distinct,
then a rank window, no hints), before and after the queries, as a session gets
faster while it is used; the mean is for comparison on the same machine and data.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from martweave.plans.catalog import QUERIES
from martweave.sources.retail_tables import open_tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = [
    "sales_person_incentive",
    "customer_monthly_mart",
    "sales_person_rank",
    "customer_detail_mart",
    "sales_team_detail_mart",
    "ledger_current_status",
]
# Queries that write files before they read them: timed once, warm.
ONCE = os.environ.get("BENCH_ONCE", "union_by_name_batches,partitioned_mart_readback,landed_sales_to_marts").split(",")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("martweave-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _joined_views(spark: SparkSession, folder: str) -> None:
    tables = open_tables(spark, folder)
    tables.sales_fact().createOrReplaceTempView("bench_fact")
    tables.customer().createOrReplaceTempView("bench_customer")
    tables.store().createOrReplaceTempView("bench_store")
    tables.sales_team().createOrReplaceTempView("bench_team")
    spark.sql(
        """SELECT f.customer_id, c.first_name, c.last_name, c.address, c.phone_number, f.store_id, f.sales_person_id,
                  t.first_name AS seller_first, t.last_name AS seller_last,
                  substring(f.sales_date, 1, 7) AS month, f.total_cost
           FROM bench_fact f
           JOIN bench_customer c ON f.customer_id = c.customer_id
           JOIN bench_store s ON f.store_id = s.id
           JOIN bench_team t ON f.sales_person_id = t.id"""
    ).createOrReplaceTempView("bench_detail")


def incentive_window_form(spark: SparkSession, folder: str) -> DataFrame:
    _joined_views(spark, folder)
    return spark.sql(
        """WITH sellers AS (
             SELECT DISTINCT store_id, sales_person_id, concat(seller_first, ' ', seller_last) AS full_name, month,
                    sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, month) AS total_sales
             FROM bench_detail),
           ranked AS (
             SELECT *, rank() OVER (PARTITION BY store_id, month ORDER BY total_sales DESC) AS rnk FROM sellers)
           SELECT store_id, sales_person_id, full_name, month, total_sales,
                  round(CASE WHEN rnk = 1 THEN total_sales * 0.10 ELSE 0 END, 2) AS incentive
           FROM ranked"""
    )


def customer_window_form(spark: SparkSession, folder: str) -> DataFrame:
    _joined_views(spark, folder)
    return spark.sql(
        """SELECT DISTINCT customer_id, concat(first_name, ' ', last_name) AS full_name, address, phone_number, month,
                  sum(total_cost) OVER (PARTITION BY customer_id, month) AS total_sales
           FROM bench_detail"""
    )


def timed(spark: SparkSession, query, repeats: int) -> float:
    seconds = []
    for _ in range(repeats + 1):
        start = time.perf_counter()
        query(spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:] or seconds), 3)


def main() -> None:
    spark = session()
    forms = {"sales_person_incentive": incentive_window_form, "customer_monthly_mart": customer_window_form}
    before = {name: timed(spark, form, REPEATS) for name, form in forms.items()}
    queries = {name: timed(spark, QUERIES[name], REPEATS) for name in HEADLINE}
    after = {name: timed(spark, form, REPEATS) for name, form in forms.items()}
    window_form = {name: round((before[name] + after[name]) / 2, 3) for name in forms}
    queries |= {name: timed(spark, QUERIES[name], 0) for name in ONCE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "window_form": window_form,
                "window_form_before": before,
                "window_form_after": after,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
