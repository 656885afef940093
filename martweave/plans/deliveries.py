"""Sales files in several shapes, written from the star-schema tables.

Every order line lands in exactly one delivery, chosen by its order date. The
shapes are those a header gate has to tell apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.contract import MANDATORY_COLUMNS
from martweave.sources.retail_tables import open_tables
from martweave.workspace import as_table, new_folder

# Delivery of an order date, as SQL that Spark and DuckDB both read.
DELIVERY_SQL = """CASE
  WHEN sales_date < DATE '1997-01-01' THEN 'clean'
  WHEN sales_date < DATE '1998-01-01' THEN 'one_extra'
  WHEN sales_date < DATE '1999-01-01' THEN 'two_extras'
  WHEN sales_date < DATE '2000-01-01' THEN 'short'
  WHEN sales_date < DATE '2000-07-01' THEN 'other_case'
  WHEN sales_date < DATE '2001-01-01' THEN 'text'
  ELSE 'shuffled' END"""

# The two columns outside the contract, as SQL for both engines.
PAYMENT_SQL = "CASE return_flag WHEN 'A' THEN 'cash' WHEN 'R' THEN 'UPI' END"
NOTE_SQL = "CASE line_status WHEN 'O' THEN 'on credit' END"


def _shape(rows: DataFrame, delivery: str) -> DataFrame:
    columns: list[Column | str] = list(MANDATORY_COLUMNS)
    if delivery == "one_extra":
        columns.append("payment_mode")
    elif delivery == "two_extras":
        columns = ["payment_mode", *columns, "note"]
    elif delivery == "short":
        columns = [c for c in columns if c != "store_id"] + ["payment_mode"]
    elif delivery == "other_case":
        columns[0] = F.col("customer_id").alias("Customer_ID")
    elif delivery == "shuffled":
        columns = columns[::-1]
    return rows.select(*columns)


DELIVERIES = ["clean", "one_extra", "two_extras", "short", "other_case", "text", "shuffled"]


def land_deliveries(spark: SparkSession, folder: str) -> str:
    """Writes all sales below a new landing folder, one sub-folder per delivery."""
    landing = new_folder(spark, "landing")
    sales = as_table(
        open_tables(spark, folder)
        .sales_fact(product_names=True)
        .withColumn("delivery", F.expr(DELIVERY_SQL))
        .withColumn("payment_mode", F.expr(PAYMENT_SQL))
        .withColumn("note", F.expr(NOTE_SQL)),
        "sales",
    )
    for delivery in DELIVERIES:
        rows = _shape(sales.where(F.col("delivery") == delivery), delivery)
        target = f"{landing}/delivery={delivery}"
        if delivery == "text":
            rows.select(F.concat_ws("|", *[F.col(c).cast("string") for c in MANDATORY_COLUMNS])).write.text(target)
        else:
            rows.write.option("header", "true").csv(target)
    return landing


def land_clean(rows: DataFrame, landing: str) -> None:
    """Adds ``rows`` to ``landing`` as files that hold just the mandatory columns."""
    rows.select(*MANDATORY_COLUMNS).write.mode("append").option("header", "true").csv(landing)


def land_named(rows: DataFrame, landing: str, name: str, columns: list[str] = MANDATORY_COLUMNS, files: int = 8) -> None:
    """Lands ``rows`` as ``name-0.csv``, ``name-1.csv`` ..., replacing files of these names.

    The rows are not shuffled for it: tasks are put together. Where they are fewer than ``files``, the last files have a header only.
    """
    spark = rows.sparkSession
    written = new_folder(spark, "named")
    rows.select(*columns).coalesce(files).write.option("header", "true").csv(written)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(landing))
    parts = sorted(s.getPath().toString() for s in system.globStatus(hadoop.Path(written, "part-*.csv")))
    for i in range(files):
        target = hadoop.Path(landing, f"{name}-{i}.csv")
        system.delete(target, False)
        if i < len(parts):
            system.rename(hadoop.Path(parts[i]), target)
        else:
            stream = system.create(target, True)
            stream.write(bytearray(",".join(columns).encode() + b"\n"))
            stream.close()


def land_empty(spark: SparkSession, landing: str, name: str) -> None:
    """Lands a file of no bytes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(landing, name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()


def delivery_of(path: Column) -> Column:
    """The delivery named in a landed file's path."""
    return F.regexp_extract(path, "delivery=([a-z_]+)", 1)
