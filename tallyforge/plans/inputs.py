"""Input tables of the reports, derived from the generic star schema and event table.

Each text is valid for Spark and DuckDB once its markers are filled in: table names in
braces, ``<iso_dow>`` (day of week, Monday = 1) and ``<array>`` (array constructor).
The dimensions leave out one segment and one part type, so that some users and posts are unknown.
Amounts pass through six decimals before they are cut to cents, because engines disagree on
which way a binary half cent goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyforge.sources.schemas import table

KEYED_EVENTS = "(SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM {events})"

BANK_TXN = f"""
SELECT e.event_id AS transaction_id, e.user_id AS customer_id,
  cast(e.ts AS date) AS transaction_date, e.ts AS transaction_ts, cast(hour(e.ts) AS int) AS hour_of_day,
  CASE WHEN <iso_dow> >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour(e.ts) < 6 THEN 1 ELSE 0 END AS is_night_transaction,
  n.n_name AS country, concat(r.r_name, '-', cast(c.c_custkey % 4 AS string)) AS city,
  CASE e.k % 5 WHEN 0 THEN 'grocery' WHEN 1 THEN 'travel' WHEN 2 THEN 'electronics'
    WHEN 3 THEN 'fuel' ELSE 'gaming' END AS merchant_category,
  CASE e.k % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'wire' WHEN 2 THEN 'wallet' ELSE 'cash' END AS payment_method,
  c.c_mktsegment AS device_type, cast(16 + (e.user_id * 7) % 60 AS int) AS customer_age,
  cast(CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE 450 + (e.k * 5 + e.user_id) % 400 END AS int) AS credit_score,
  c.c_acctbal AS account_balance, e.value AS transaction_amount,
  cast(1 + (e.user_id * 3) % 30 AS int) AS transaction_freq_monthly,
  CASE WHEN e.k % 3 = 0 THEN 1 ELSE 0 END AS is_international,
  cast((e.k + e.event_id) % 6 AS int) AS failed_attempts,
  CASE WHEN e.event_id % 10 = 0 THEN 1 ELSE 0 END AS pin_changed_recently,
  CASE WHEN e.event_type = 'error' AND e.k < 50 THEN 1 ELSE 0 END AS is_fraud,
  CASE WHEN e.event_type = 'error' AND e.k < 50 THEN
    CASE e.event_id % 4 WHEN 0 THEN 'phishing' WHEN 1 THEN 'skimming' ELSE 'takeover' END END AS fraud_type
FROM {KEYED_EVENTS} e
JOIN {{customer}} c ON c.c_custkey = e.user_id
JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
JOIN {{region}} r ON r.r_regionkey = n.n_regionkey
"""

TELECOM = """
SELECT c_name AS customerID, CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
  CASE WHEN h % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
  CASE WHEN h % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
  tenure, 'Yes' AS PhoneService, CASE WHEN h % 4 < 2 THEN 'Yes' ELSE 'No' END AS MultipleLines,
  CASE WHEN h % 5 < 2 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
  CASE h % 3 WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'One year' ELSE 'Two year' END AS Contract,
  CASE (h + c_nationkey) % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
    WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
  inet AS InternetService,
  CASE WHEN inet = 'No' THEN 'No internet service' WHEN h % 7 < 3 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
  CASE WHEN inet = 'No' THEN 'No internet service' WHEN h % 5 < 2 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
  CASE WHEN inet = 'No' THEN 'No internet service' WHEN h % 11 < 5 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
  CASE WHEN inet = 'No' THEN 'No internet service' WHEN h % 13 < 5 THEN 'Yes' ELSE 'No' END AS TechSupport,
  CASE WHEN inet = 'No' THEN 'No internet service' WHEN h % 4 = 0 THEN 'Yes' ELSE 'No' END AS StreamingTV,
  CASE WHEN inet = 'No' THEN 'No internet service' WHEN h % 6 < 2 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
  monthly AS MonthlyCharges,
  CASE WHEN tenure = 0 THEN ' ' ELSE cast(cast(monthly * tenure
    + CASE WHEN h % 9 = 0 THEN 300 ELSE 0 END AS decimal(12,2)) AS string) END AS TotalCharges,
  CASE WHEN (h % 3 = 0 AND tenure <= 24) OR h % 17 = 0 THEN 'Yes' ELSE 'No' END AS Churn
FROM (SELECT *, (c_custkey * 7919 + 13) % 1009 AS h, cast((c_custkey * 31) % 73 AS int) AS tenure,
        cast(cast(cast(20 + abs(c_acctbal) / 100 AS decimal(12,6)) AS decimal(12,2)) AS double) AS monthly,
        CASE (c_custkey * 17) % 5 WHEN 0 THEN 'No' WHEN 1 THEN 'DSL' WHEN 2 THEN 'DSL'
          ELSE 'Fiber optic' END AS inet FROM {customer}) c
"""

SOCIAL = f"""
SELECT CASE WHEN event_id % 211 = 0 THEN NULL ELSE cast(event_id AS string) END AS event_id, et AS event_type,
  concat('U', cast(user_id + CASE WHEN event_id % 29 = 0 THEN 900000000 ELSE 0 END AS string)) AS user_id,
  CASE WHEN et IN ('LIKE','COMMENT','SHARE','VIDEO_VIEW','POST_CREATED') AND event_id % 53 <> 0
    THEN concat('P', cast(CASE WHEN k < 60 THEN k % 20 ELSE event_id END AS string)) END AS post_id,
  CASE WHEN et IN ('FOLLOW','PROFILE_VISIT') OR event_id % 2 = 0
    THEN concat('U', cast(user_id + k AS string)) END AS target_user_id,
  CASE WHEN et = 'POST_CREATED' THEN
    <array>(concat('#t', cast(k % 10 AS string)), concat('#t', cast(k % 7 + 3 AS string))) END AS hashtags,
  CASE WHEN et = 'COMMENT' THEN CASE k % 6 WHEN 0 THEN 'Love this! ' WHEN 1 THEN 'Amazing content and great work'
    WHEN 2 THEN 'This is terrible' WHEN 3 THEN 'best of the worst' WHEN 4 THEN 'You are the best!'
    ELSE 'Interesting' END END AS comment_text,
  CASE WHEN et = 'POST_CREATED' THEN 'video' END AS content_type,
  CASE WHEN et = 'VIDEO_VIEW' THEN cast(15 + k AS double) END AS video_duration_sec,
  CASE WHEN et = 'VIDEO_VIEW' THEN least(value, cast(15 + k AS double)) END AS watch_time_sec,
  ts
FROM (SELECT *, CASE WHEN event_type = 'click' THEN 'LIKE' WHEN event_type = 'view' AND k < 60 THEN 'VIDEO_VIEW'
    WHEN event_type = 'view' THEN 'POST_CREATED' WHEN event_type = 'purchase' THEN 'SHARE'
    WHEN event_type = 'signup' AND k < 50 THEN 'FOLLOW' WHEN event_type = 'signup' THEN 'PROFILE_VISIT'
    WHEN k < 90 THEN 'COMMENT' ELSE 'BOGUS' END AS et
  FROM {KEYED_EVENTS} e0) e
"""

SENSOR = """
SELECT event_id AS reading_id, concat('S00', cast(user_id % 3 + 1 AS string)) AS sensor_id,
  18 + value / 10 AS temperature, ts FROM {events}
"""

PAGE_VIEW = f"""
SELECT concat('U', cast(user_id AS string)) AS user_id, concat('/page/', cast(k % 8 AS string)) AS page, ts
FROM {KEYED_EVENTS} e
"""

RISK = """
SELECT o_orderkey AS id, concat('C', cast(o_custkey AS string)) AS customer_id, o_totalprice / 25 AS amount,
  cast(430 + (o_orderkey * 37) % 400 AS int) AS credit_score,
  cast(o_orderkey % 7 AS int) AS failed_attempts, n_name AS country
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

CITY_CUSTOMERS = """
SELECT c_custkey AS customer_id, c_name AS name,
  concat(r_name, '-', cast(c_custkey % 4 AS string)) AS city
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

CUSTOMER_ORDERS = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM {orders}
"""

USER_DIM = """
SELECT concat('U', cast(c_custkey AS string)) AS user_id, concat('user_', cast(c_custkey AS string)) AS username,
  CASE WHEN c_acctbal > 9000 THEN 'influencer' ELSE 'regular' END AS user_type,
  cast(50 + (c_custkey * 7919) % 4950 AS int) AS follower_count,
  n_name AS country FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

POST_DIM = """
SELECT concat('P', cast(p_partkey AS string)) AS post_id,
  concat('U', cast(p_partkey * 7 AS string)) AS user_id,
  CASE p_partkey % 3 WHEN 0 THEN 'image' WHEN 1 THEN 'reel' END AS content_type,
  CASE WHEN p_partkey % 5 = 4 THEN NULL ELSE concat('["#t', cast(p_partkey % 6 AS string), '"]') END AS hashtags
FROM {part}
"""

USER_TXN = """
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, o_totalprice / 10 AS amount, o_orderdate AS ts
FROM {orders}
"""

INPUTS = {
    "bank_txn": BANK_TXN,
    "telecom": TELECOM,
    "social": SOCIAL,
    "sensor": SENSOR,
    "page_view": PAGE_VIEW,
    "risk": RISK,
    "city_customers": CITY_CUSTOMERS,
    "customer_orders": CUSTOMER_ORDERS,
    "user_dim": USER_DIM,
    "post_dim": POST_DIM,
    "user_txn": USER_TXN,
}

NTZ = T.TimestampNTZType()
BASE_TABLES = {
    "region": table(r_regionkey="int", r_name="string"),
    "nation": table(n_nationkey="int", n_name="string", n_regionkey="int"),
    "customer": table(
        c_custkey="bigint", c_name="string", c_nationkey="int", c_acctbal="double", c_mktsegment="string"
    ),
    "part": table(
        p_partkey="bigint", p_name="string", p_brand="string", p_type="string", p_size="int", p_retailprice="double"
    ),
    "orders": table(
        o_orderkey="bigint", o_custkey="bigint", o_orderstatus="string", o_totalprice="double", o_orderdate=NTZ,
        o_orderpriority="string",
    ),
    "events": table(
        event_id="bigint", ts=NTZ, user_id="bigint", event_type="string", value="double", props="string"
    ),
}


def load(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """The input table ``name`` over the Parquet files in ``data_dir``."""
    text = INPUTS[name].replace("<iso_dow>", "(weekday(e.ts) + 1)").replace("<array>", "array")
    used = {
        t: spark.read.schema(schema).parquet(f"{data_dir}/{t}.parquet")
        for t, schema in BASE_TABLES.items() if "{" + t + "}" in text
    }
    return spark.sql(text, **used)


def duckdb_text(name: str) -> str:
    """The same table for DuckDB, where the base tables are views of their own name."""
    text = INPUTS[name].replace("<iso_dow>", "isodow(e.ts)").replace("<array>", "list_value")
    for table in BASE_TABLES:
        text = text.replace("{" + table + "}", table)
    return text
