"""Application, event and call data derived from the given tables, as SQL.

The text of every view runs unchanged in Spark SQL and in DuckDB (see FIXTURES.md), so both sides
of a check start from the same rows. All views cover their whole source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditweave.session import use_utc

_APPLICATION_TABLES = ("orders", "customer", "nation", "region")

APPLICATIONS_RAW = """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('app_', cast(o_orderkey AS varchar(20))) END AS application_id,
  CASE WHEN o_orderkey % 89 = 0 THEN 'not-a-time' ELSE substr(cast(o_orderdate AS varchar(30)), 1, 19) END AS event_time,
  concat('cust_', cast(o_custkey AS varchar(20))) AS customer_id,
  r_name AS region_code,
  c_mktsegment AS product_type,
  CASE WHEN o_orderkey % 97 = 0 THEN '0' WHEN o_orderkey % 83 = 0 THEN '' WHEN o_orderkey % 79 = 0 THEN 'n/a'
       WHEN o_orderkey % 17 = 0 THEN concat(cast(cast(floor(o_totalprice) AS int) AS varchar(20)), '.75')
       ELSE cast(cast(floor(o_totalprice) AS int) AS varchar(20)) END AS requested_amount,
  cast(6 * (1 + o_custkey % 10) AS varchar(20)) AS term_months,
  cast(280 + (o_orderkey * 7) % 640 AS varchar(20)) AS credit_score,
  CASE WHEN 280 + (o_orderkey * 7) % 640 >= 700 THEN 'low' WHEN 280 + (o_orderkey * 7) % 640 >= 560 THEN 'medium' ELSE 'high' END AS risk_level,
  CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'rejected' ELSE 'manual_review' END AS decision_status,
  CASE WHEN o_orderkey % 43 = 0 THEN '1' WHEN o_orderkey % 41 = 0 THEN '99999999'
       WHEN o_orderstatus = 'F' THEN cast(cast(floor(o_totalprice) AS int) AS varchar(20)) WHEN o_orderstatus = 'O' THEN '0'
       ELSE cast(cast(floor(o_totalprice) AS int) - cast(floor(o_totalprice) AS int) % 1000 AS varchar(20)) END AS approved_amount,
  o_orderpriority AS channel,
  CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderstatus = 'P' OR o_orderkey % 12 = 0 THEN 'true' ELSE 'false' END AS employee_review_flag,
  cast(5 + (o_orderkey * 31) % 596 AS varchar(20)) AS processing_time_sec
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

EVENT_MESSAGES = """
SELECT 'loan_applications' AS topic, cast(o_orderkey % 3 AS int) AS partition, o_orderkey AS offset, o_orderdate AS timestamp,
  CASE WHEN o_orderkey % 53 = 0 THEN 'not json'
       WHEN o_orderkey % 59 = 0 THEN '{"decision_status":"approved"}'
  ELSE concat('{"application_id":"loan_', cast(o_orderkey AS varchar(20)),
    '","customer":{"customer_id":"cust_', cast(o_custkey AS varchar(20)), '","region":"', r_name,
    '"},"loan":{"amount":', cast(cast(floor(o_totalprice) AS int) AS varchar(20)), ',"term_months":', cast(6 * (1 + o_custkey % 10) AS varchar(20)),
    '},"scoring":{"score":', cast(280 + (o_orderkey * 7) % 640 AS varchar(20)), ',"risk_level":"',
    CASE WHEN 280 + (o_orderkey * 7) % 640 >= 700 THEN 'low' WHEN 280 + (o_orderkey * 7) % 640 >= 560 THEN 'medium' ELSE 'high' END, '"}',
    CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN ',"documents":[]'
      WHEN 2 THEN ',"documents":[{"type":"passport","status":"verified"}]'
      WHEN 3 THEN ',"documents":[{"type":"passport","status":"pending"},{"type":"bank_statement","status":"rejected"}]'
      ELSE ',"documents":null' END,
    ',"decision_status":"', CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'rejected' ELSE 'manual_review' END,
    '","submitted_at":"', substr(cast(o_orderdate AS varchar(30)), 1, 10), 'T00:00:00Z"}') END AS value
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

TRANSACTIONS = """
SELECT concat('call_', cast(event_id % 701 AS varchar(20))) AS call_id,
  ts AS call_time,
  CASE WHEN event_id % 71 = 0 THEN NULL ELSE concat('client_', cast(user_id AS varchar(20))) END AS client_id,
  CASE user_id % 6 WHEN 0 THEN 'DE-HE' WHEN 1 THEN 'DE-BE' WHEN 2 THEN 'DE-BY' WHEN 3 THEN 'DE-HH' WHEN 4 THEN 'DE-NW' ELSE 'DE-SN' END AS region_code,
  CASE event_id % 4 WHEN 0 THEN 'credit_card_offer' WHEN 1 THEN 'cash_loan_offer' WHEN 2 THEN 'mortgage_offer' ELSE 'insurance_offer' END AS campaign_type,
  CASE WHEN event_id % 73 = 0 THEN NULL ELSE CASE event_type WHEN 'purchase' THEN 'answered' WHEN 'click' THEN 'answered' WHEN 'view' THEN 'missed' WHEN 'signup' THEN 'busy' ELSE 'failed' END END AS call_status,
  CASE event_id % 3 WHEN 0 THEN 'interested' WHEN 1 THEN 'not_interested' ELSE 'callback_requested' END AS client_response,
  cast(floor(value) AS bigint) AS duration_sec,
  event_id % 5 = 0 AS follow_up_required,
  cast(event_id % 2 AS int) AS batch_no,
  event_id AS seq
FROM events
"""

# The same calls under keys that grow with the data: three events share one, in turns of both batches.
TRANSACTIONS_WIDE = TRANSACTIONS.replace("cast(event_id % 701 AS varchar(20))", "cast(cast(floor(event_id / 3) AS bigint) AS varchar(20))")

# Every shape of number text that the cast rules tell apart, spread over all orders.
NUMBER_TEXT = """
SELECT o_orderkey, CASE o_orderkey % 20
    WHEN 0 THEN concat(' ', cast(o_custkey AS varchar(20)), ' ')
    WHEN 1 THEN concat('+', cast(o_custkey AS varchar(20)))
    WHEN 2 THEN concat('-', cast(o_custkey AS varchar(20)), '.7')
    WHEN 3 THEN concat(cast(o_custkey AS varchar(20)), '.')
    WHEN 4 THEN concat('.', cast(o_custkey AS varchar(20)))
    WHEN 5 THEN '.'
    WHEN 6 THEN concat(cast(o_custkey AS varchar(20)), 'e3')
    WHEN 7 THEN '3000000000'
    WHEN 8 THEN '-2147483648'
    WHEN 9 THEN ''
    WHEN 10 THEN 'abc'
    WHEN 11 THEN concat('00000000000', cast(o_custkey AS varchar(20)))
    WHEN 12 THEN concat(cast(o_custkey AS varchar(20)), '.1.2')
    WHEN 13 THEN '+'
    WHEN 14 THEN NULL
    WHEN 15 THEN concat(cast(o_custkey AS varchar(20)), '.75')
    WHEN 16 THEN '2150000000'
    WHEN 17 THEN '2147483647'
    WHEN 18 THEN '12345678901234567890123'
    ELSE cast(o_custkey AS varchar(20)) END AS number_text
FROM orders
"""

BOOLEAN_TEXT = """
SELECT o_orderkey, CASE o_orderkey % 13
    WHEN 0 THEN 'true' WHEN 1 THEN 'T' WHEN 2 THEN 'yes' WHEN 3 THEN '1' WHEN 4 THEN '  true '
    WHEN 5 THEN 'FALSE' WHEN 6 THEN 'f' WHEN 7 THEN 'No' WHEN 8 THEN '0' WHEN 9 THEN ''
    WHEN 10 THEN 'maybe' WHEN 11 THEN NULL ELSE 'n' END AS flag_text
FROM orders
"""

# Shapes of time text; only the first is what the pattern accepts.
TIME_TEXT = """
SELECT o_orderkey, CASE o_orderkey % 11
    WHEN 0 THEN substr(cast(o_orderdate AS varchar(30)), 1, 10)
    WHEN 1 THEN concat(substr(cast(o_orderdate AS varchar(30)), 1, 10), 'T10:15:11Z')
    WHEN 2 THEN concat(substr(cast(o_orderdate AS varchar(30)), 1, 10), ' 10:15:11.5')
    WHEN 3 THEN concat(' ', substr(cast(o_orderdate AS varchar(30)), 1, 10), ' 10:15:11')
    WHEN 4 THEN concat(substr(cast(o_orderdate AS varchar(30)), 1, 4), '-02-30 10:15:11')
    WHEN 5 THEN 'not-a-time'
    WHEN 6 THEN NULL
    WHEN 7 THEN concat(substr(cast(o_orderdate AS varchar(30)), 1, 10), ' 25:15:11')
    WHEN 8 THEN concat(substr(cast(o_orderdate AS varchar(30)), 1, 7), '-32 10:15:11')
    ELSE concat(substr(cast(o_orderdate AS varchar(30)), 1, 10), ' 10:15:11') END AS time_text
FROM orders
"""

# Flat event records before encoding: up to two documents, a score of NULL now and then.
EVENT_RECORDS = """
SELECT o_orderkey AS row_number, concat('cust_', cast(o_custkey AS varchar(20))) AS customer_id,
  r_name AS region_code, cast(floor(o_totalprice) AS int) AS loan_amount,
  cast(6 * (1 + o_custkey % 10) AS int) AS term_months,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE cast(280 + (o_orderkey * 7) % 640 AS int) END AS credit_score,
  CASE WHEN o_orderkey % 3 > 0 THEN 'passport' END AS first_type,
  CASE WHEN o_orderkey % 3 > 0 THEN 'verified' END AS first_status,
  CASE WHEN o_orderkey % 3 > 1 THEN 'bank_statement' END AS second_type,
  CASE WHEN o_orderkey % 3 > 1 THEN 'pending' END AS second_status,
  CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'rejected' ELSE 'manual_review' END AS decision_status,
  o_orderdate AS submitted_at
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

VIEWS = {
    "f_applications_raw": APPLICATIONS_RAW,
    "f_event_messages": EVENT_MESSAGES,
    "f_transactions": TRANSACTIONS,
    "f_transactions_wide": TRANSACTIONS_WIDE,
    "f_number_text": NUMBER_TEXT,
    "f_boolean_text": BOOLEAN_TEXT,
    "f_time_text": TIME_TEXT,
    "f_event_records": EVENT_RECORDS,
}

# The given tables that each view reads.
SOURCES = {
    "f_applications_raw": _APPLICATION_TABLES,
    "f_event_messages": _APPLICATION_TABLES,
    "f_transactions": ("events",),
    "f_transactions_wide": ("events",),
    "f_number_text": ("orders",),
    "f_boolean_text": ("orders",),
    "f_time_text": ("orders",),
    "f_event_records": _APPLICATION_TABLES,
}

def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables in ``sf_dir``."""
    use_utc(spark)
    for table in SOURCES[name]:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(VIEWS[name])
