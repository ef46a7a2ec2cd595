"""The star schema of FIXTURES.md as common table expressions for the SQL oracle."""

from __future__ import annotations

STAR = """ds_customer AS (
SELECT CAST(c_custkey AS INT) AS c_customer_sk,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS c_preferred_cust_flag,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 97 AS INT) END AS c_current_cdemo_sk,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey % 60 AS INT) END AS c_current_hdemo_sk,
  CAST(c_nationkey AS INT) AS c_current_addr_sk,
  'UNITED STATES' AS c_birth_country,
  CAST(1930 + c_custkey % 70 AS INT) AS c_birth_year,
  CAST(1 + c_custkey % 12 AS INT) AS c_birth_month,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(1 + c_custkey % 28 AS INT) END AS c_birth_day,
  CASE WHEN c_custkey % 2 = 0 THEN 'Mr.' ELSE 'Ms.' END AS c_salutation,
  c_mktsegment AS c_first_name,
  c_name AS c_last_name,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE concat(c_name, '@example.com') END AS c_email_address
FROM customer
),
ds_customer_demographics AS (
SELECT DISTINCT CAST(c_custkey % 97 AS INT) AS cd_demo_sk,
  CASE WHEN c_custkey % 97 % 2 = 0 THEN 'M' ELSE 'F' END AS cd_gender,
  CASE c_custkey % 97 % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'M' WHEN 2 THEN 'D' WHEN 3 THEN 'W' ELSE 'U' END AS cd_marital_status,
  CASE c_custkey % 97 % 4 WHEN 0 THEN 'Primary' WHEN 1 THEN 'Secondary' WHEN 2 THEN 'College' ELSE 'Unknown' END AS cd_education_status,
  CAST(500 * (1 + c_custkey % 97 % 20) AS INT) AS cd_purchase_estimate,
  CASE c_custkey % 97 % 3 WHEN 0 THEN 'Good' WHEN 1 THEN 'Low Risk' ELSE 'High Risk' END AS cd_credit_rating,
  CAST(c_custkey % 97 % 7 AS INT) AS cd_dep_count,
  CAST(c_custkey % 97 % 6 AS INT) AS cd_dep_employed_count,
  CAST(c_custkey % 97 % 4 AS INT) AS cd_dep_college_count
FROM customer
),
ds_household_demographics AS (
SELECT DISTINCT CAST(c_custkey % 60 AS INT) AS hd_demo_sk,
  CAST(8 + c_custkey % 60 % 20 AS INT) AS hd_income_band_sk,
  CASE c_custkey % 60 % 4 WHEN 0 THEN '0-500' WHEN 1 THEN '501-1000' WHEN 2 THEN '>10000' ELSE 'Unknown' END AS hd_buy_potential,
  CAST(c_custkey % 60 % 10 AS INT) AS hd_dep_count,
  CAST(c_custkey % 60 % 6 - 1 AS INT) AS hd_vehicle_count
FROM customer
),
ds_income_band AS (
SELECT CAST(n_nationkey AS INT) AS ib_income_band_sk,
  CAST(n_nationkey * 10000 + 1 AS INT) AS ib_lower_bound,
  CAST((n_nationkey + 1) * 10000 AS INT) AS ib_upper_bound
FROM nation
),
ds_customer_address AS (
SELECT CAST(n_nationkey AS INT) AS ca_address_sk, n_name AS ca_city, substr(r_name, 1, 2) AS ca_state,
  'United States' AS ca_country,
  CAST(-5 - n_nationkey % 4 AS DECIMAL(5,2)) AS ca_gmt_offset,
  CASE n_nationkey % 3 WHEN 0 THEN 'apartment' WHEN 1 THEN 'condo' ELSE 'single family' END AS ca_location_type
FROM nation JOIN region ON n_regionkey = r_regionkey
),
ds_date_dim AS (
SELECT DISTINCT CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) AS d_date_sk
FROM orders
),
ds_sales AS (
SELECT CASE WHEN l_linenumber <= 3 THEN 'store' WHEN l_linenumber <= 5 THEN 'catalog' ELSE 'web' END AS channel,
  CASE WHEN l_suppkey % 50 = 7 THEN NULL
       WHEN (l_linenumber <= 3 AND o_custkey % 7 = 3) OR (l_linenumber IN (4, 5) AND o_custkey % 5 = 1)
         OR (l_linenumber >= 6 AND o_custkey % 3 = 2) THEN CAST(-1 - o_custkey AS INT)
       ELSE CAST(o_custkey AS INT) END AS customer_sk,
  CASE WHEN l_suppkey % 50 = 0 THEN NULL
       ELSE CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)
         + CASE WHEN year(o_orderdate) > 2000 THEN 1000000 ELSE 0 END AS INT) END AS sold_date_sk,
  CAST(l_partkey AS INT) AS item_sk,
  CASE WHEN l_suppkey % 50 = 3 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS ext_sales_price,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_quantity AS DECIMAL(4,0)) * 1200 AS DECIMAL(12,2)) AS net_profit,
  CAST(l_quantity AS INT) AS quantity,
  l_returnflag AS return_flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
ds_returns AS (
SELECT channel, customer_sk, ext_sales_price AS return_amt, quantity AS return_quantity
FROM ds_sales WHERE return_flag = 'R'
),
store_sales AS (
SELECT customer_sk AS ss_customer_sk, sold_date_sk AS ss_sold_date_sk, item_sk AS ss_item_sk,
  ext_sales_price AS ss_ext_sales_price, net_profit AS ss_net_profit, quantity AS ss_quantity
FROM ds_sales WHERE channel = 'store'
),
catalog_sales AS (
SELECT customer_sk AS cs_bill_customer_sk, sold_date_sk AS cs_sold_date_sk, item_sk AS cs_item_sk,
  ext_sales_price AS cs_ext_sales_price, net_profit AS cs_net_profit, quantity AS cs_quantity
FROM ds_sales WHERE channel = 'catalog'
),
web_sales AS (
SELECT customer_sk AS ws_bill_customer_sk, sold_date_sk AS ws_sold_date_sk, item_sk AS ws_item_sk,
  ext_sales_price AS ws_ext_sales_price, net_profit AS ws_net_profit, quantity AS ws_quantity
FROM ds_sales WHERE channel = 'web'
),
store_returns AS (
SELECT customer_sk AS sr_customer_sk, return_amt AS sr_return_amt, return_quantity AS sr_return_quantity
FROM ds_returns WHERE channel = 'store'
),
catalog_returns AS (
SELECT customer_sk AS cr_refunded_customer_sk, return_amt AS cr_return_amount, return_quantity AS cr_return_quantity
FROM ds_returns WHERE channel = 'catalog'
),
web_returns AS (
SELECT customer_sk AS wr_refunded_customer_sk, return_amt AS wr_return_amt, return_quantity AS wr_return_quantity
FROM ds_returns WHERE channel = 'web'
)"""


def with_star(query: str, *more: str) -> str:
    """``query`` behind the star's CTEs and any further ones, each given as ``name AS (...)``."""
    return "WITH " + ",\n".join([STAR, *more]) + "\n" + query.strip()
