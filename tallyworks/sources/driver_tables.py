"""The shared test tables, read as the inputs of the financial operators.

The view texts are fixed values: the agreed mapping from the test tables to ledger, customer, card
and trading inputs. They run unchanged on Spark SQL and on the SQL engine that checks the results.
``{name}`` stands for a test table or an earlier view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyworks.sources.readers import read_parquet

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp""",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
}

VIEWS = {
    "accounts": """
SELECT c_custkey AS account_id, c_custkey AS customer_id,
  CASE c_custkey % 3 WHEN 0 THEN 'CHECKING' WHEN 1 THEN 'SAVINGS' ELSE 'LOAN' END AS account_type,
  CAST('2010-01-01' AS DATE) AS open_date, 'USD' AS currency_code,
  CASE c_custkey % 10 WHEN 0 THEN 'CLOSED' WHEN 1 THEN 'FROZEN' WHEN 2 THEN 'DORMANT' ELSE 'OPEN' END AS status,
  CASE WHEN c_custkey % 17 <> 0 THEN r_name END AS region_id,
  CASE WHEN c_custkey % 17 <> 0 THEN substring(r_name, 1, 2) END AS region_code,
  CASE WHEN c_custkey % 23 <> 3 THEN CAST(c_nationkey * 5 - 60 AS DOUBLE) END AS home_lat,
  CAST(c_nationkey * 14 - 170 AS DOUBLE) AS home_lon
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "ledger_customers": """
SELECT c_custkey AS customer_id,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'RETAIL' WHEN 'MACHINERY' THEN 'RETAIL'
    WHEN 'FURNITURE' THEN 'PREMIUM' ELSE 'PRIVATE_WEALTH' END AS customer_segment,
  CASE WHEN c_custkey % 6 = 0 THEN 'PENDING' ELSE 'VERIFIED' END AS kyc_status
FROM {customer} WHERE c_custkey % 13 <> 0""",
    "customer_moments": """
SELECT *, CAST('2024-01-02 00:00:00' AS TIMESTAMP) + INTERVAL '1' MINUTE * (customer_id * 17 % 700) AS first_change,
  CAST('2024-01-02 14:00:00' AS TIMESTAMP) + INTERVAL '1' MINUTE * (customer_id * 29 % 580) AS second_change
FROM {ledger_customers}""",
    "ledger_customer_history": """
SELECT customer_id, customer_segment, kyc_status, CAST('2020-01-01 00:00:00' AS TIMESTAMP) AS effective_start_date,
  first_change AS effective_end_date
FROM {customer_moments}
UNION ALL
SELECT customer_id, 'PREMIUM', kyc_status, first_change,
  CASE WHEN customer_id % 11 = 0 THEN second_change - INTERVAL '2' HOUR ELSE second_change END
FROM {customer_moments}
UNION ALL
SELECT customer_id, 'RETAIL', 'VERIFIED', second_change, CAST('9999-12-31 23:59:59' AS TIMESTAMP)
FROM {customer_moments}""",
    "raw_transactions": """
SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),
    CAST(l_suppkey AS STRING)) AS trx_uuid,
  o_custkey AS source_account_id, l_suppkey AS destination_account_id,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'REVERSAL_CREDIT'
    WHEN l_returnflag = 'R' THEN 'REVERSAL_DEBIT'
    WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'FEE'
    WHEN l_returnflag = 'A' AND l_partkey % 3 = 0 THEN 'INTERNAL_TRANSFER_REVERSAL'
    ELSE 'PAYMENT' END AS transaction_type,
  CAST(l_extendedprice AS DECIMAL(18,4)) AS amount_base_currency, 'USD' AS currency_code,
  CASE WHEN l_orderkey % 5 <> 0 THEN CAST(1 + l_tax AS DECIMAL(10,4)) END AS exchange_rate,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' DAY * (o_orderkey % 4)
    + INTERVAL '1' MINUTE * ((o_orderkey * 7 + l_linenumber * 37) % 1440) AS transaction_timestamp,
  CASE l_partkey % 10 WHEN 0 THEN '7995' WHEN 1 THEN '6012' ELSE '5411' END AS merchant_category_code,
  o_orderpriority AS channel,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING_CLEARANCE' ELSE 'FAILED' END AS status,
  CAST(NULL AS STRING) AS error_code
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "prev_balances": """
SELECT c_custkey AS account_id, CAST('2024-01-01' AS DATE) AS balance_date,
  CAST(c_acctbal * 50 AS DECIMAL(18,4)) AS ending_balance
FROM {customer} WHERE c_custkey % 7 <> 0""",
    "cc_transactions": """
SELECT event_id AS trx_id, user_id % 10 AS account_id,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS merchant_id, value AS amount,
  CAST(ts AS TIMESTAMP) AS trx_timestamp, CAST(ts AS DATE) AS trx_date
FROM {events}""",
    "merchants": """
SELECT DISTINCT merchant_id, CAST(merchant_id * 1.2 - 60 AS DOUBLE) AS merchant_lat,
  CAST(merchant_id * 3.4 - 170 AS DOUBLE) AS merchant_lon
FROM {cc_transactions} WHERE merchant_id < 80""",
    "onboarding_customers": """
SELECT c_custkey AS customer_id, substring(c_name, 1, 8) AS first_name, substring(c_name, 10, 9) AS last_name,
  md5(c_name) AS ssn_hash, CAST('1980-06-15' AS DATE) AS dob, n_name AS country, c_mktsegment AS state
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "kyc": """
SELECT o_custkey AS customer_id, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS verification_date,
  CASE o_orderstatus WHEN 'F' THEN 'VERIFIED' WHEN 'O' THEN 'PENDING' ELSE 'REJECTED' END AS status,
  o_orderpriority AS risk_rating
FROM {orders}""",
    "funding_accounts": """
SELECT o_custkey AS customer_id, CASE WHEN o_orderkey % 8 < 3 THEN 'ACTIVE' ELSE 'CLOSED' END AS account_status,
  CASE WHEN o_custkey % 4 = 0 THEN o_totalprice / 50 ELSE o_totalprice END AS initial_deposit,
  CAST(o_orderdate AS DATE) AS open_date
FROM {orders}""",
    "scd_updates": """
SELECT o_custkey AS customer_id, concat('F', CAST(o_orderkey % 3 AS STRING)) AS first_name,
  concat('L', CAST(o_custkey % 50 AS STRING)) AS last_name,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '' END AS email_address,
  concat('+', CAST(o_orderkey AS STRING)) AS phone_number, 'addr' AS residential_address,
  CASE WHEN o_orderkey % 4 = 0 THEN 'MARRIED' ELSE 'SINGLE' END AS marital_status,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) - INTERVAL '1' DAY * (o_orderkey % 9)
    + INTERVAL '1' MINUTE * (o_orderkey * 7 % 1440) AS update_ts,
  o_orderkey AS seq
FROM {orders}""",
    "scd_dim": """
SELECT concat('sk', CAST(c_custkey AS STRING)) AS customer_surrogate_key, c_custkey AS customer_id,
  'F0' AS first_name, concat('L', CAST(c_custkey % 50 AS STRING)) AS last_name,
  CAST(NULL AS STRING) AS email_address, '+0' AS phone_number, 'addr' AS residential_address,
  'SINGLE' AS marital_status, CAST('2020-01-01 00:00:00' AS TIMESTAMP) AS effective_start_date,
  CAST('9999-12-31 23:59:59' AS TIMESTAMP) AS effective_end_date, true AS is_active
FROM {customer} WHERE c_custkey % 10 <> 0
UNION ALL
SELECT concat('old', CAST(c_custkey AS STRING)), c_custkey, 'F0', 'Lold', NULL, '+0', 'addr', 'SINGLE',
  CAST('2015-01-01 00:00:00' AS TIMESTAMP), CAST('2020-01-01 00:00:00' AS TIMESTAMP), false
FROM {customer} WHERE c_custkey % 4 = 0""",
    "parent_orders": """
SELECT o_orderkey AS order_id, o_custkey AS client_id, o_custkey % 5 AS ticker,
  CASE o_orderkey % 5 WHEN 0 THEN 'BUY' WHEN 1 THEN 'BUY' WHEN 2 THEN 'SELL' WHEN 3 THEN 'SELL' ELSE 'CROSS' END AS side,
  (o_orderkey % 50 + 10) * 10 AS requested_shares,
  CAST('2024-01-02 14:10:00' AS TIMESTAMP) + INTERVAL '1' MINUTE * (o_orderkey * 37 % 390) AS t0
FROM {orders}""",
    "order_events": """
SELECT l_orderkey AS order_id, client_id, CAST('2024-01-02' AS DATE) AS trade_date,
  CASE WHEN l_orderkey % 2 = 0 THEN 'V1' ELSE 'V2' END AS protocol_version,
  CASE WHEN l_orderkey % 2 = 0 THEN 'TRADE' ELSE 'FILL' END AS event_type,
  CASE l_returnflag WHEN 'R' THEN 'FILLED' WHEN 'A' THEN 'PARTIAL' ELSE 'BUSTED' END AS status,
  t0 + INTERVAL '1' MINUTE * (l_linenumber * 11 + l_orderkey % 10) AS event_timestamp,
  CASE WHEN l_orderkey % 4 <> 1 THEN t0 + INTERVAL '1' MINUTE * (l_linenumber * 11 + l_orderkey % 10 - 1) END
    AS routing_timestamp,
  l_quantity AS last_exec_qty, round(20 + l_extendedprice / 10000, 2) AS last_exec_price,
  l_linenumber * 1000000 + l_partkey AS seq
FROM {lineitem} JOIN {parent_orders} ON l_orderkey = order_id
UNION ALL
SELECT order_id, client_id, CAST('2024-01-02' AS DATE), 'V2', 'ACK', 'NEW', t0, t0 - INTERVAL '1' MINUTE, NULL, NULL, 0
FROM {parent_orders} WHERE order_id % 7 <> 0
UNION ALL
SELECT order_id, client_id, CAST('2024-01-02' AS DATE), 'V2', 'END', 'DONE_FOR_DAY', t0 + INTERVAL '90' MINUTE,
  NULL, NULL, NULL, 99
FROM {parent_orders} WHERE order_id % 6 <> 0""",
    "quotes": """
SELECT event_id AS quote_id, user_id % 4 AS ticker,
  CAST('2024-01-02 14:00:00' AS TIMESTAMP) + INTERVAL '1' SECOND * (event_id * 41 % 27000) AS quote_timestamp,
  value AS best_bid, value + 0.05 AS best_ask
FROM {events} WHERE event_type IN ('view', 'error') AND (user_id % 4 <> 3 OR event_id % 40 = 0)""",
    "trades": """
SELECT event_id AS trade_id, user_id % 4 AS ticker,
  CAST('2024-01-02 14:00:00' AS TIMESTAMP) + INTERVAL '1' SECOND * (event_id * 43 % 27000) AS trade_timestamp,
  value AS trade_price, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) + 1 AS trade_size
FROM {events} WHERE event_type IN ('click', 'purchase')""",
}

_NAME = re.compile(r"\{(\w+)\}")


def needs(name: str) -> list[str]:
    """Tables and views a view reads."""
    return list(dict.fromkeys(_NAME.findall(VIEWS[name])))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table or view. Spark expands views into one plan, so only used columns are read."""
    if name in TABLES:
        return read_parquet(spark, f"{sf_dir}/{name}.parquet", StructType.fromDDL(TABLES[name]))
    return spark.sql(VIEWS[name], **{need: load(spark, sf_dir, need) for need in needs(name)})
