"""The registered queries once more, as plain SQL over the star-schema tables."""

from __future__ import annotations

from martweave.plans.deliveries import DELIVERY_SQL, NOTE_SQL, PAYMENT_SQL

_FACT = """
fact AS (
  SELECT o.o_custkey AS customer_id, CAST(s.s_nationkey AS BIGINT) AS store_id, p.p_name AS product_name,
         CAST(o.o_orderdate AS DATE) AS sales_date, l.l_suppkey AS sales_person_id,
         CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)
              // CAST(l.l_quantity AS BIGINT) AS DOUBLE) / 100 AS price,
         CAST(l.l_quantity AS BIGINT) AS quantity, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_cost,
         l.l_returnflag AS return_flag, l.l_linestatus AS line_status
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

_CUSTOMER = """
  SELECT c_custkey AS customer_id, substring(c_name, 1, 8) AS first_name, substring(c_name, 10, 9) AS last_name,
         n_name AS address, CAST(c_nationkey AS VARCHAR) AS pincode,
         '91' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone_number
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""

_TEAM = """
  SELECT s_suppkey AS id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
         n_name AS address, CAST(s_nationkey AS VARCHAR) AS pincode, s_nationkey AS manager_id, 'N' AS is_manager
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

_STORE = """
store AS (
  SELECT n_nationkey AS id, r_name AS store_manager_name FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_DIMS = f"ct AS ({_CUSTOMER}), st AS ({_TEAM}), {_STORE}"

# Customers of nation 3 and sales people of nation 5 a second time, under another name.
_TWO_NAMES = f"""
ct1 AS ({_CUSTOMER}), st1 AS ({_TEAM}), {_STORE},
ct AS (SELECT * FROM ct1 UNION ALL SELECT * REPLACE ('Second' AS last_name) FROM ct1 WHERE pincode = '3'),
st AS (SELECT * FROM st1 UNION ALL SELECT * REPLACE ('Second' AS last_name) FROM st1 WHERE pincode = '5')"""

_DETAIL = """
detail AS (
  SELECT f.store_id, f.sales_date, f.sales_person_id, f.total_cost,
         ct.customer_id, ct.first_name, ct.last_name, ct.address, ct.pincode, ct.phone_number,
         store.store_manager_name, st.manager_id, st.is_manager,
         st.first_name AS sales_person_first_name, st.last_name AS sales_person_last_name,
         st.address AS sales_person_address, st.pincode AS sales_person_pincode,
         strftime(f.sales_date, '%Y-%m') AS month
  FROM fact f
  JOIN ct ON f.customer_id = ct.customer_id
  JOIN store ON f.store_id = store.id
  JOIN st ON f.sales_person_id = st.id
)"""

_JOINED = f"WITH {_FACT}, {_DIMS}, {_DETAIL}"
_JOINED_TWO_NAMES = f"WITH {_FACT}, {_TWO_NAMES}, {_DETAIL}"

_SELLERS = """
sellers AS (
  SELECT DISTINCT store_id, sales_person_id, sales_person_first_name || ' ' || sales_person_last_name AS full_name,
         month AS sales_month,
         sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, month) AS total_sales
  FROM detail
),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST) AS rnk FROM sellers
)"""

_INCENTIVE = f"""{_SELLERS}
SELECT store_id, sales_person_id, full_name, sales_month, CAST(total_sales AS DOUBLE) AS total_sales,
       CAST(round(CASE WHEN rnk = 1 THEN total_sales * CAST(0.10 AS DECIMAL(3,2)) ELSE 0 END, 2) AS DOUBLE) AS incentive
FROM ranked"""

_CUSTOMER_MONTHLY = """
SELECT customer_id, full_name, address, phone_number, sales_date_month, CAST(total AS DOUBLE) AS total_sales
FROM (
  SELECT DISTINCT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
         month AS sales_date_month, sum(total_cost) OVER (PARTITION BY customer_id, month) AS total
  FROM detail
)"""

_LANDED = f"""WITH {_FACT},
landed AS (
  SELECT *, {DELIVERY_SQL} AS delivery, {PAYMENT_SQL} AS payment_mode, {NOTE_SQL} AS note FROM fact
)"""
_REJECTED = "('short', 'other_case', 'text')"

_SALES_COLUMNS = """customer_id, store_id, product_name, CAST(sales_date AS VARCHAR) AS sales_date, sales_person_id,
       price, quantity, CAST(total_cost AS DOUBLE) AS total_cost"""

_EVENTS = """
WITH ledger AS (
  SELECT 'sales_' || user_id || '.csv' AS file_name, 'landing/' || event_type AS file_location,
         CASE WHEN event_type = 'purchase' THEN 'I' ELSE 'A' END AS status, ts
  FROM events
),
state AS (
  SELECT file_name, arg_max(status, ts) AS status, max(ts) FILTER (status = 'I') AS done FROM ledger GROUP BY file_name
)"""


def _line(*columns: str, by: str = ",") -> str:
    """A landed text line; NULL extras are empty."""
    return f" || '{by}' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


_PRICE = "CAST(price AS DECIMAL(18,2))"
_SHORT = _line(
    "customer_id", "product_name", "sales_date", "sales_person_id", _PRICE, "quantity", "total_cost", "payment_mode"
)
_FULL = ("customer_id", "store_id", "product_name", "sales_date", "sales_person_id", _PRICE, "quantity", "total_cost")

ORACLES: dict[str, str] = {
    "fact_conform": f"WITH {_FACT} SELECT {_SALES_COLUMNS} FROM fact",
    "fact_enrich": f"""{_JOINED}
SELECT customer_id, store_id, CAST(sales_date AS VARCHAR) AS sales_date, sales_person_id,
       CAST(total_cost AS DOUBLE) AS total_cost, CAST(NULL AS VARCHAR) AS extra_column,
       first_name, last_name, address, pincode, phone_number, store_manager_name,
       sales_person_first_name, sales_person_last_name, sales_person_address, sales_person_pincode,
       CAST(manager_id AS BIGINT) AS manager_id, is_manager
FROM detail""",
    "customer_detail_mart": f"""{_JOINED}
SELECT customer_id, first_name, last_name, address, pincode, phone_number,
       CAST(sales_date AS VARCHAR) AS sales_date, CAST(total_cost AS DOUBLE) AS total_cost
FROM detail""",
    "sales_team_detail_mart": f"""{_JOINED}
SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name, store_manager_name,
       CAST(manager_id AS BIGINT) AS manager_id, is_manager, sales_person_address, sales_person_pincode,
       CAST(sales_date AS VARCHAR) AS sales_date, CAST(total_cost AS DOUBLE) AS total_cost, month AS sales_month
FROM detail""",
    "sales_person_monthly_total": f"""{_JOINED}
SELECT store_id, sales_person_id, sales_person_first_name || ' ' || sales_person_last_name AS full_name,
       month AS sales_month, CAST(sum(total_cost) AS DOUBLE) AS total_sales
FROM detail GROUP BY 1, 2, 3, 4""",
    "sales_person_rank": f"""{_JOINED}, {_SELLERS}
SELECT store_id, sales_person_id, full_name, sales_month, CAST(total_sales AS DOUBLE) AS total_sales, rnk FROM ranked""",
    "sales_person_incentive": f"{_JOINED}, {_INCENTIVE}",
    "sales_person_incentive_of_detail": f"{_JOINED}, {_INCENTIVE}",
    "sales_person_incentive_two_names": f"{_JOINED_TWO_NAMES}, {_INCENTIVE}",
    "customer_monthly_mart": f"{_JOINED} {_CUSTOMER_MONTHLY}",
    "customer_monthly_mart_two_names": f"{_JOINED_TWO_NAMES} {_CUSTOMER_MONTHLY}",
    "customer_monthly_mart_windowed": f"{_JOINED_TWO_NAMES} {_CUSTOMER_MONTHLY}",
    "header_verdicts": f"""{_LANDED}
SELECT delivery, CASE WHEN delivery IN {_REJECTED} THEN 'rejected' ELSE 'accepted' END AS verdict,
       CASE WHEN delivery = 'text' THEN 'not a csv file'
            WHEN delivery IN {_REJECTED} THEN 'missing columns' ELSE '' END AS reason,
       CASE delivery WHEN 'text' THEN NULL WHEN 'short' THEN 'store_id'
                     WHEN 'other_case' THEN 'customer_id' ELSE '' END AS missing,
       CASE delivery WHEN 'one_extra' THEN 'payment_mode' WHEN 'short' THEN 'payment_mode'
                     WHEN 'two_extras' THEN 'payment_mode,note' WHEN 'other_case' THEN 'Customer_ID' ELSE '' END AS extras,
       count(*) AS data_lines
FROM landed GROUP BY delivery""",
    "landed_file_kinds": f"{_LANDED} SELECT DISTINCT delivery, delivery <> 'text' AS is_csv FROM landed",
    "quarantined_lines": f"""{_LANDED}
SELECT CASE delivery WHEN 'text' THEN 'not a csv file' ELSE 'missing columns' END AS reason,
       CASE delivery WHEN 'short' THEN {_SHORT} WHEN 'text' THEN {_line(*_FULL, by="|")} ELSE {_line(*_FULL)} END AS value
FROM landed WHERE delivery IN {_REJECTED}""",
    "extras_folded": f"""{_LANDED}
SELECT customer_id, store_id, CAST(sales_date AS VARCHAR) AS sales_date, sales_person_id,
       CAST(total_cost AS DOUBLE) AS total_cost,
       CASE delivery WHEN 'one_extra' THEN coalesce(payment_mode, '')
                     WHEN 'two_extras' THEN concat_ws(', ', payment_mode, note) END AS extra_column
FROM landed WHERE delivery NOT IN {_REJECTED}""",
    "extras_by_name": f"""{_LANDED}
SELECT 'payment_mode' AS extra, payment_mode AS value, count(*) AS sales
FROM landed WHERE delivery IN ('one_extra', 'two_extras') GROUP BY payment_mode
UNION ALL
SELECT 'note', note, count(*) FROM landed WHERE delivery = 'two_extras' GROUP BY note""",
    "union_by_name_batches": f"{_LANDED} SELECT {_SALES_COLUMNS} FROM landed WHERE delivery NOT IN {_REJECTED}",
    "snapshot_versioned_readback": f"""{_JOINED}
SELECT run_ts, customer_id, phone_number, CAST(sales_date AS VARCHAR) AS sales_date,
       CAST(total_cost AS DOUBLE) AS total_cost
FROM detail, (SELECT CAST(1 AS BIGINT) AS run_ts UNION ALL SELECT CAST(2 AS BIGINT))""",
    "ledger_unfinished": f"""{_EVENTS}
SELECT DISTINCT file_name FROM state
WHERE status = 'A' AND file_name IN (SELECT 'sales_' || c_custkey || '.csv' FROM customer)""",
    "ledger_current_status": f"{_EVENTS} SELECT file_name, status FROM state",
    "ledger_rows": f"""{_EVENTS}
SELECT l.file_name, l.file_location, strftime(l.ts, '%Y-%m-%d %H:%M:%S') AS created_date,
       CASE WHEN s.done >= l.ts THEN strftime(s.done, '%Y-%m-%d %H:%M:%S') END AS updated_date,
       CASE WHEN s.done >= l.ts THEN 'I' ELSE 'A' END AS status
FROM ledger l JOIN state s ON l.file_name = s.file_name WHERE l.status = 'A'""",
    "ledger_marked_files": f"""{_LANDED}
SELECT DISTINCT delivery, CASE WHEN delivery IN {_REJECTED} THEN 'A' ELSE 'I' END AS status
FROM landed WHERE delivery <> 'text'""",
    "jdbc_roundtrip_customer": _CUSTOMER,
    "stream_pickup_count": f"""WITH {_FACT}
SELECT CAST(CASE WHEN sales_date < DATE '1998-01-01' THEN 0 ELSE 1 END AS BIGINT) AS pickup, count(*) AS sales,
       CAST(sum(total_cost) AS DOUBLE) AS amount
FROM fact GROUP BY 1""",
    "recomputed_months": f"{_JOINED} {_CUSTOMER_MONTHLY}",
    "landed_sales_to_marts": f"{_JOINED}, {_INCENTIVE}",
}
ORACLES["month_loses_partners"] = f"""{_JOINED} SELECT * FROM ({_CUSTOMER_MONTHLY})
WHERE customer_id IN (SELECT customer_id FROM ct WHERE pincode <> '3')"""
ORACLES["totals_merged_over_deliveries"] = ORACLES["customer_monthly_mart"]
ORACLES["abandoned_run_is_invisible"] = f"SELECT * FROM ({ORACLES['sales_team_detail_mart']}) WHERE store_id % 2 = 0"
ORACLES["fact_enrich_hot_customer"] = ORACLES["fact_enrich"].replace(
    "o.o_custkey AS customer_id", "CASE WHEN o.o_orderkey % 3 = 0 THEN 1 ELSE o.o_custkey END AS customer_id"
)
ORACLES["rerun_moves_months"] = ORACLES["customer_monthly_mart"]
ORACLES["quarantined_files_of_one_name"] = f"""WITH {_FACT}
SELECT CASE WHEN sales_date < DATE '1998-01-01' THEN 'early' ELSE 'late' END AS folder, 'missing columns' AS reason,
       count(*) AS data_lines
FROM fact GROUP BY ALL"""
_EARLY = "sales_date < DATE '1998-01-01'"
ORACLES["extras_widened"] = f"""WITH {_FACT}
SELECT customer_id, sales_person_id, store_id AS code,
       CAST(quantity AS DOUBLE) + CASE WHEN {_EARLY} THEN 0 ELSE 0.5 END AS units,
       CAST(sales_date AS VARCHAR) || CASE WHEN {_EARLY} THEN ' 00:00:00' ELSE ' 12:30:00' END AS noted,
       CASE WHEN {_EARLY} THEN '' ELSE 'q' END || CAST(quantity AS VARCHAR) AS label
FROM fact"""
_CELL = "SELECT customer_id, store_id, sales_person_id, CAST(sales_date AS VARCHAR) AS sales_date"
ORACLES["unparsed_cells"] = f"""WITH {_FACT}
{_CELL}, 'quantity' AS "column", 'x' || CAST(quantity AS VARCHAR) AS text FROM fact WHERE return_flag = 'R'
UNION ALL {_CELL}, 'total_cost', 'n/a' FROM fact WHERE return_flag <> 'N'"""
ORACLES["pickup_refuses_unreadable_files"] = f"""WITH {_FACT},
parts AS (SELECT CASE WHEN sales_date < DATE '1998-01-01' THEN 'early' ELSE 'late' END AS delivery, count(*) AS rows
          FROM fact GROUP BY 1)
SELECT delivery, 'counted' AS outcome, rows FROM parts
UNION ALL SELECT delivery, 'hidden name, which readers skip', 1 FROM parts
UNION ALL SELECT delivery, 'missing columns', 1 FROM parts"""
ORACLES["stream_pickup_archived"] = f"""WITH {_FACT}
SELECT count(*) AS sales, CAST(sum(total_cost) AS DOUBLE) AS amount FROM fact"""
for _name in (
    "landing_read_twice",
    "redelivered_file_counts",
    "pickup_after_rejected_delivery",
    "pickup_with_new_checkpoint",
    "dimensions_from_database",
    "concurrent_runs_count_once",
    "replaced_files_retract",
):
    ORACLES[_name] = ORACLES["sales_person_incentive"]
ORACLES["parquet_mart_readback"] = ORACLES["customer_detail_mart"]
ORACLES["partitioned_mart_readback"] = ORACLES["sales_team_detail_mart"]
ORACLES["snapshot_partitioned_readback"] = ORACLES["sales_team_detail_mart"]
ORACLES["jdbc_mart_append"] = ORACLES["sales_person_incentive"]
