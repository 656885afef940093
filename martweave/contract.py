"""Column contracts of the sales files, the dimensions and the marts."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names a sales file must carry, in mart order.
MANDATORY_COLUMNS = [
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
]

EXTRA_COLUMN = "extra_column"

MONEY = T.DecimalType(18, 2)
MONEY_TOTAL = T.DecimalType(28, 2)

# Whole numbers are bigint: a key beyond the int range is kept, not nulled.
FACT_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("sales_date", T.DateType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("price", MONEY),
        T.StructField("quantity", T.LongType()),
        T.StructField("total_cost", MONEY),
        T.StructField(EXTRA_COLUMN, T.StringType()),
    ]
)

# Cells of a sale whose text is no value of their column's type; NULL when there is none.
UNPARSED = "unparsed"
UNPARSED_TYPE = T.ArrayType(T.StructType([T.StructField("column", T.StringType()), T.StructField("text", T.StringType())]))

# The dimension columns the marts need.
CUSTOMER_COLUMNS = ["customer_id", "first_name", "last_name", "address", "pincode", "phone_number"]
STORE_COLUMNS = ["id", "store_manager_name"]
SALES_TEAM_COLUMNS = ["id", "first_name", "last_name", "address", "pincode", "manager_id", "is_manager"]

# The mart columns, in order.
CUSTOMER_DETAIL_COLUMNS = [
    "customer_id",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "sales_date",
    "total_cost",
]
SALES_TEAM_DETAIL_COLUMNS = [
    "store_id",
    "sales_person_id",
    "sales_person_first_name",
    "sales_person_last_name",
    "store_manager_name",
    "manager_id",
    "is_manager",
    "sales_person_address",
    "sales_person_pincode",
    "sales_date",
    "total_cost",
    "sales_month",
]
CUSTOMER_MONTHLY_COLUMNS = [
    "customer_id",
    "full_name",
    "address",
    "phone_number",
    "sales_date_month",
    "total_sales",
]
INCENTIVE_COLUMNS = [
    "store_id",
    "sales_person_id",
    "full_name",
    "sales_month",
    "total_sales",
    "incentive",
]

# Run ledger states.
STARTED = "A"
DONE = "I"

INCENTIVE_RATE = "0.10"
REFUSED = "R"
