"""The reference entities expressed over the test tables.

The tables are clean, so each view adds dirt by key. The texts run unchanged in
Spark SQL and in the checking database; ``{name}`` stands for a base table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.schemas import CRM_SOURCES, conform

_DMY = "CONCAT(SUBSTR(d, 9, 2), '/', SUBSTR(d, 6, 2), '/', SUBSTR(d, 1, 4))"
_MDY = "CONCAT(SUBSTR(d, 6, 2), '-', SUBSTR(d, 9, 2), '-', SUBSTR(d, 1, 4))"
_MON = (
    "CONCAT(SUBSTR(d, 9, 2), ' ', SUBSTR('JanFebMarAprMayJunJulAugSepOctNovDec', "
    "3 * CAST(SUBSTR(d, 6, 2) AS INT) - 2, 3), ' ', SUBSTR(d, 1, 4))"
)

USERS = f"""
SELECT k AS user_id, CONCAT('  ', LOWER(c_name), ' ') AS full_name,
  CASE k % 100 WHEN 0 THEN 'invalid-email' WHEN 1 THEN CONCAT('user', CAST(k AS STRING), 'example.com')
    WHEN 2 THEN CONCAT('user', CAST(k AS STRING), '@@example.com') WHEN 9 THEN NULL
    ELSE CONCAT(' User', CAST(k - CASE WHEN k % 20 = 7 THEN 1 ELSE 0 END AS STRING), '@Example.com')
  END AS email,
  CASE WHEN k % 12 = 0 THEN NULL WHEN k % 3 = 0 THEN CONCAT('+84 9', LPAD(CAST(k AS STRING), 8, '0'))
    WHEN k % 10 = 1 THEN '12345' ELSE CONCAT('09', LPAD(CAST(k AS STRING), 8, '0')) END AS phone,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN '  ' ELSE n_name END AS city,
  CASE WHEN k % 14 = 0 THEN NULL ELSE r_name END AS country,
  CASE k % 40 WHEN 0 THEN {_DMY} WHEN 1 THEN {_MDY} WHEN 2 THEN REPLACE(d, '-', '')
    WHEN 3 THEN 'N/A' WHEN 4 THEN {_MON} ELSE d END AS created_at,
  CASE k % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'f' WHEN 2 THEN 'yes' WHEN 3 THEN 'False' ELSE NULL END
    AS is_active
FROM (SELECT c_custkey AS k, c_name, n_name, r_name,
        CAST(DATE '2020-01-01' + CAST(c_custkey % 1400 AS INT) AS STRING) AS d
      FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
      JOIN {{region}} ON n_regionkey = r_regionkey) t
"""

PRODUCTS = """
SELECT p_partkey AS product_id, CONCAT(' ', p_name) AS product_name, p_type AS category,
  CASE WHEN p_partkey % 12 = 0 THEN NULL ELSE p_brand END AS subcategory,
  CAST(CASE WHEN p_partkey % 50 = 0 THEN -p_retailprice ELSE p_retailprice END AS DECIMAL(12,2))
    AS unit_price,
  CAST(CASE WHEN p_partkey % 12 = 1 THEN NULL ELSE p_retailprice * 0.6 END AS DECIMAL(12,2))
    AS cost_price,
  p_size - 3 AS stock_qty,
  CASE WHEN p_partkey % 12 = 2 THEN NULL ELSE CONCAT('Supplier#', CAST(p_partkey % 100 AS STRING)) END
    AS supplier
FROM {part}
"""

ORDERS = f"""
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE o_custkey END AS user_id,
  CASE o_orderkey % 150 WHEN 0 THEN {_DMY} WHEN 1 THEN {_MDY} WHEN 2 THEN REPLACE(d, '-', '')
    WHEN 3 THEN 'N/A' ELSE d END AS order_date,
  CASE WHEN o_orderkey % 97 = 0 THEN ' Shiped' WHEN o_orderkey % 97 = 1 THEN 'canceld'
    WHEN o_orderkey % 31 = 0 THEN 'returned' WHEN o_orderstatus = 'F' THEN 'Delivered '
    WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'pending' END AS status,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS shipping_city,
  CAST(CASE WHEN o_orderkey % 50 = 0 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(14,2))
    AS total_amount,
  CASE WHEN o_orderkey % 12 = 5 THEN NULL ELSE CAST(o_orderkey % 130 - 10 AS DECIMAL(5,2)) END
    AS discount,
  o_orderdate + INTERVAL 9131 DAY AS created_at
FROM (SELECT *, CAST(CAST(o_orderdate + INTERVAL 9131 DAY AS DATE) AS STRING) AS d FROM {{orders}}) t
"""

ORDER_ITEMS = """
SELECT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
  CASE WHEN l_partkey % 60 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS quantity,
  CAST(CASE WHEN l_partkey % 50 = 1 THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(12,2))
    AS unit_price,
  l_suppkey AS tie_suppkey, CAST(l_shipdate AS DATE) AS tie_shipdate
FROM {lineitem}
"""

TRANSACTIONS = f"""
SELECT event_id AS txn_id, CASE WHEN event_id % 12 = 0 THEN NULL ELSE event_id % 1000 END AS order_id,
  user_id,
  CASE event_id % 30 WHEN 0 THEN {_DMY} WHEN 1 THEN 'N/A' ELSE d END AS txn_date,
  CAST(CASE WHEN event_id % 50 = 0 THEN -value ELSE value END AS DECIMAL(14,2)) AS amount,
  CASE event_type WHEN 'click' THEN 'credit_card' WHEN 'view' THEN 'debit_card'
    WHEN 'signup' THEN 'bank_transfer' WHEN 'purchase' THEN ' E_Wallet' ELSE 'COD' END AS payment_method,
  CASE event_id % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'Failed ' WHEN 2 THEN 'pending'
    ELSE 'refunded' END AS status,
  CASE event_id % 5 WHEN 0 THEN 'VND' WHEN 1 THEN 'usd ' WHEN 2 THEN 'EUR' WHEN 3 THEN 'VN'
    ELSE 'us' END AS currency,
  ts AS created_at
FROM (SELECT *, CAST(CAST(ts AS DATE) AS STRING) AS d FROM {{events}}) t
"""

CRM_CUST = """
SELECT CONCAT(CASE WHEN c_custkey % 10 = 0 THEN 'LEAD' ELSE 'CUST' END, CAST(c_custkey AS STRING), ' ')
    AS cust_id, c_name AS cust_name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN 'bad@'
    ELSE CONCAT(REPLACE(c_name, '#', '.'), '@mail.com') END AS email,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CONCAT('09-', LPAD(CAST(c_custkey AS STRING), 8, '0')) END
    AS phone,
  CONCAT(' Street ', CAST(c_custkey % 90 AS STRING)) AS address, n_name AS city,
  CONCAT('S', CAST(c_nationkey AS STRING)) AS state,
  LPAD(CAST(c_custkey % 1000 AS STRING), 5, '7') AS zip_code,
  DATE '2020-01-01' + CAST(c_custkey % 1400 AS INT) AS registration_date,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS customer_type,
  CASE WHEN c_custkey % 16 = 0 THEN NULL ELSE 'BLOCKED' END AS status
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

ERP_CUST = """
SELECT CONCAT(CASE WHEN c_custkey % 3 = 0 THEN 'ACCT' ELSE 'CUST' END, CAST(c_custkey AS STRING))
    AS customer_code, c_name AS customer_full_name,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CONCAT(REPLACE(c_name, '#', '.'), '@ERP.com') END AS contact_email,
  CASE WHEN c_custkey % 10 < 6 THEN NULL ELSE CONCAT('(08) ', CAST(c_custkey AS STRING)) END
    AS contact_phone,
  CASE WHEN c_custkey % 4 = 0 THEN 'BUSINESS' ELSE 'INDIVIDUAL' END AS business_type,
  CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS credit_limit,
  CASE WHEN c_custkey % 18 = 2 THEN 'CLOSED' ELSE NULL END AS account_status
FROM {customer}
"""

ERP_LOC = """
SELECT CONCAT('LOC', CAST(n_nationkey AS STRING)) AS location_id, CONCAT(n_name, ' Branch') AS location_name,
  n_name AS address_line1, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE r_name END AS address_line2,
  n_name AS city, CONCAT('S', CAST(n_nationkey AS STRING)) AS state, 'Vietnam ' AS country,
  LPAD(CAST(n_nationkey AS STRING), 5, '7') AS postal_code,
  CASE WHEN n_nationkey % 11 = 5 THEN NULL ELSE LOWER(r_name) END AS region
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

CRM_PRD = """
SELECT CONCAT(CASE WHEN p_partkey % 10 = 0 AND p_partkey % 50 <> 0 THEN 'ITEM' ELSE 'PROD' END,
    CAST(p_partkey AS STRING)) AS product_id, CONCAT(' ', p_name) AS product_name,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CONCAT(p_type, ' item') END AS description,
  LOWER(p_type) AS category, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS brand,
  CAST(CASE WHEN p_partkey % 50 = 0 THEN -p_retailprice ELSE p_retailprice END AS DECIMAL(18,2))
    AS unit_price,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE 'VND' END AS currency,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'ACTIVE' END AS status
FROM {part}
"""

ERP_PX = """
SELECT CONCAT(CASE WHEN p_partkey % 3 = 0 THEN 'SKU' ELSE 'PROD' END, CAST(p_partkey AS STRING))
    AS product_code, p_name AS product_desc,
  CONCAT('CAT', CAST(p_size AS STRING)) AS category_code,
  CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_type END AS category_name, p_brand AS subcategory,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_retailprice * 0.6 AS DECIMAL(18,2)) END AS unit_cost,
  p_size AS stock_qty, CASE WHEN p_partkey % 4 = 1 THEN NULL ELSE p_size % 10 END AS reorder_level
FROM {part}
"""

CRM_SALES = """
SELECT CONCAT('TXN', CAST(l_orderkey * 10 + l_linenumber AS STRING)) AS transaction_id,
  o_orderdate + INTERVAL 9131 DAY AS transaction_date,
  CONCAT('CUST', CAST(o_custkey AS STRING)) AS cust_id,
  CONCAT('PROD', CAST(l_partkey AS STRING)) AS product_id, l_quantity AS quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price,
  CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_pct,
  CAST(l_tax * 100 AS DECIMAL(18,2)) AS tax_amount,
  CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, o_orderpriority AS payment_method
FROM (SELECT l_orderkey, l_linenumber, MAX(l_partkey) AS l_partkey,
        MAX(CAST(l_quantity AS INT)) AS l_quantity, MAX(l_extendedprice) AS l_extendedprice,
        MAX(l_discount) AS l_discount, MAX(l_tax) AS l_tax
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber) l
JOIN {orders} ON l_orderkey = o_orderkey
"""

CHANGES = """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END
    AS event_type,
  CASE WHEN event_id % 7 = 3 THEN 'silver' ELSE 'bronze' END AS schema_name,
  CASE event_id % 4 WHEN 0 THEN 'crm_cust_info' WHEN 1 THEN 'crm_sales_details' WHEN 2 THEN 'cdc_test'
    ELSE 'unwatched' END AS table_name, user_id AS row_id, event_type AS new_status
FROM {events}
"""

RUN_LOG = """
SELECT event_id AS log_id, CONCAT('B', CAST(user_id AS STRING)) AS batch_id,
  CONCAT('public.t', CAST(event_id % 5 AS STRING)) AS table_name,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'ROLLED_BACK' WHEN 'view' THEN 'RUNNING'
    ELSE 'SUCCESS' END AS status,
  CAST(FLOOR(value * 10) AS BIGINT) AS rows_loaded, ts AS started_at
FROM {events}
"""

ETL_LOG = """
SELECT event_id AS log_id, CASE event_id % 3 WHEN 0 THEN 'load_bronze' WHEN 1 THEN 'load_silver'
    ELSE 'load_gold' END AS procedure_name,
  CASE event_id % 3 WHEN 0 THEN 'BRONZE' WHEN 1 THEN 'SILVER' ELSE 'GOLD' END AS layer,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'STARTED' ELSE 'COMPLETED' END AS status,
  ts AS start_time,
  CASE WHEN event_type = 'view' THEN NULL ELSE ts + INTERVAL 1 MILLISECOND * (event_id % 90000) END
    AS end_time,
  CAST(FLOOR(value) AS INT) AS rows_processed
FROM {events}
"""

VIEWS: dict[str, str] = {
    "users": USERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "transactions": TRANSACTIONS,
    "crm_cust_info": CRM_CUST,
    "erp_cust_az12": ERP_CUST,
    "erp_loc_a101": ERP_LOC,
    "crm_prd_info": CRM_PRD,
    "erp_px_cat_g1v2": ERP_PX,
    "crm_sales_details": CRM_SALES,
    "change_events": CHANGES,
    "run_log": RUN_LOG,
    "etl_log": ETL_LOG,
}


def base_tables(view: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", VIEWS[view])))


def bind(table: Callable[[str], DataFrame], view: str) -> DataFrame:
    """The view over the tables the callable gives; CRM views get their full column layout."""
    tables = {name: table(name) for name in base_tables(view)}
    spark = next(iter(tables.values())).sparkSession
    df = spark.sql(VIEWS[view], **tables)
    return conform(df, CRM_SOURCES[view]) if view in CRM_SOURCES else df
