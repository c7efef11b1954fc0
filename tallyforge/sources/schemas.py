"""Declared schemas. Jobs never infer a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def table(**columns: str | T.DataType) -> T.StructType:
    """Struct of nullable columns from ``name="type"`` pairs."""
    return T.StructType([T.StructField(name, KINDS[k] if isinstance(k, str) else k) for name, k in columns.items()])


BANK_TRANSACTION = table(
    transaction_id="string", customer_id="string", transaction_date="date", transaction_time="string",
    hour_of_day="int", is_weekend="int", is_night_transaction="int", country="string", city="string",
    merchant_category="string", payment_method="string", device_type="string", customer_age="int",
    credit_score="int", account_age_years="double", account_balance="double", transaction_amount="double",
    num_prev_transactions="int", transaction_freq_monthly="int", distance_from_home_km="double",
    time_since_last_txn_hrs="double", is_international="int", failed_attempts="int",
    pin_changed_recently="int", is_fraud="int", fraud_type="string",
)

# TotalCharges stays text: it holds blanks, and how to read them is the caller's choice.
TELECOM_CUSTOMER = table(
    customerID="string", gender="string", SeniorCitizen="int", Partner="string", Dependents="string",
    tenure="int", PhoneService="string", MultipleLines="string", InternetService="string",
    OnlineSecurity="string", OnlineBackup="string", DeviceProtection="string", TechSupport="string",
    StreamingTV="string", StreamingMovies="string", Contract="string", PaperlessBilling="string",
    PaymentMethod="string", MonthlyCharges="double", TotalCharges="string", Churn="string",
)

RISK_RECORD = table(
    id="bigint", customer_id="string", amount="double", credit_score="int", failed_attempts="int", country="string"
)
ORDER = table(order_id="bigint", customer_id="string", amount="double")
CUSTOMER = table(customer_id="string", name="string", city="string")
CSV_TRANSACTION = table(
    transaction_id="string", customer_id="string", amount="double", merchant="string", category="string",
    status="string",
)
TRANSACTION = table(transaction_id="string", customer_id="string", amount="double")
PAGE_VIEW = table(user_id="string", page="string", timestamp="string")
SENSOR_READING = table(sensor_id="string", temperature="double", ts="timestamp")
SOCIAL_EVENT = table(
    event_id="string", event_type="string", user_id="string", post_id="string", target_user_id="string",
    hashtags="array<string>", comment_text="string", content_type="string", video_duration_sec="double",
    watch_time_sec="double", timestamp="string",
)
USER_DIM = table(
    user_id="string", username="string", user_type="string", follower_count="int", following_count="int",
    post_count="int", country="string", created_at="timestamp",
)
POST_DIM = table(
    post_id="string", user_id="string", content_type="string", hashtags="string", created_at="timestamp"
)
API_USER = table(
    id="int", name="string", email="string", address=table(city="string"),
    company=table(name="string"),
)
