"""Bank-fraud reports over one transaction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.bands import age_band, decile_tier, first_match, two_way
from tallyforge.functions.numbers import percent, tidy
from tallyforge.operators.aggregate import (
    most_common,
    rank_by_level,
    rate_by,
    scalar,
    share_by,
    stack_dimensions,
    top_k,
    top_k_per_group,
)
from tallyforge.operators.ordered import (
    asc,
    desc,
    number_rows,
    place_in_blocks,
    rank_rows,
    running_by_day,
    tile_of,
)
from tallyforge.operators.profile import profile_columns as profile

AMOUNT = "transaction_amount"
PROFILED = [
    "transaction_id", "customer_id", "transaction_date", "transaction_ts", "hour_of_day", "country", "city",
    "merchant_category", "payment_method", "device_type", "customer_age", "credit_score",
    "transaction_amount", "is_fraud", "fraud_type",
]


def _rows() -> Column:
    return F.count(F.lit(1))


def _frauds() -> Column:
    return F.sum("is_fraud").cast("bigint")


def fraud_rate(txn: DataFrame, *keys: str) -> DataFrame:
    return rate_by(txn, keys, "is_fraud", count_as="txn_count", hits_as="fraud_count", rate_as="fraud_rate")


def _mean_amount(txn: DataFrame) -> Column:
    return scalar(txn, F.avg(AMOUNT))


def _three_sigma(txn: DataFrame) -> Column:
    return scalar(txn, F.avg(AMOUNT) + 3 * F.stddev_samp(AMOUNT))


def fraud_overview(txn: DataFrame) -> DataFrame:
    return txn.agg(
        _rows().alias("total_transactions"),
        F.count_distinct("customer_id").alias("total_customers"),
        _frauds().alias("total_fraud_transactions"),
        percent(_frauds(), _rows()).alias("fraud_percentage"),
    )


def top_countries(txn: DataFrame, k: int = 10) -> DataFrame:
    counted = txn.groupBy("country").agg(_rows().alias("transaction_count"))
    return top_k(counted, k, "transaction_count", ["country"])


def top_cities(txn: DataFrame, k: int = 10) -> DataFrame:
    return top_k(txn.groupBy("city").agg(tidy(F.sum(AMOUNT)).alias("total_value")), k, "total_value", ["city"])


def profile_columns(txn: DataFrame, columns: list[str] = PROFILED) -> DataFrame:
    return profile(txn, columns)


def dimension_shares(txn: DataFrame) -> DataFrame:
    stacked = stack_dimensions(txn, ["payment_method", "device_type", "merchant_category"], [])
    return share_by(stacked, ["dimension", "value"], within=["dimension"], count_as="txn_count",
                    share_as="percentage")


def top_customers(txn: DataFrame, k: int = 20) -> DataFrame:
    spent = txn.groupBy("customer_id").agg(tidy(F.sum(AMOUNT)).alias("total_amount"), _rows().alias("txn_count"))
    return top_k(spent, k, "total_amount", ["customer_id"])


def with_age_group(txn: DataFrame) -> DataFrame:
    return txn.withColumn("age_group", age_band(F.col("customer_age")))


def amount_by_age(txn: DataFrame) -> DataFrame:
    return with_age_group(txn).groupBy("age_group").agg(
        _rows().alias("txn_count"), tidy(F.avg(AMOUNT)).alias("avg_amount")
    )


def fraud_by_age(txn: DataFrame) -> DataFrame:
    return fraud_rate(with_age_group(txn), "age_group")


def dormant_accounts(txn: DataFrame, k: int = 20) -> DataFrame:
    """Customers with a balance above, and a frequency below, the average of all transactions."""
    balance, frequency = F.avg("account_balance"), F.avg("transaction_freq_monthly")
    per_customer = txn.groupBy("customer_id").agg(
        balance.alias("b"), frequency.alias("f"), _rows().alias("txn_count")
    )
    quiet = per_customer.where((F.col("b") > scalar(txn, balance)) & (F.col("f") < scalar(txn, frequency)))
    shown = quiet.select(
        "customer_id", tidy(F.col("b")).alias("avg_balance"), "txn_count", tidy(F.col("f")).alias("avg_monthly_freq")
    )
    return top_k(shown, k, "avg_balance", ["customer_id"])


def country_averages(txn: DataFrame) -> DataFrame:
    return txn.groupBy("country").agg(
        tidy(F.avg("account_balance")).alias("avg_balance"),
        tidy(F.avg("credit_score")).alias("avg_credit_score"),
    )


def fraud_by_merchant(txn: DataFrame) -> DataFrame:
    return fraud_rate(txn, "merchant_category")


def fraud_by_payment(txn: DataFrame) -> DataFrame:
    return fraud_rate(txn, "payment_method")


def fraud_by_device(txn: DataFrame) -> DataFrame:
    return fraud_rate(txn, "device_type")


def fraud_type_share(txn: DataFrame) -> DataFrame:
    return share_by(txn.where("is_fraud = 1"), ["fraud_type"], count_as="count", share_as="percentage")


def fraud_timing(txn: DataFrame) -> DataFrame:
    labelled = txn.withColumns({
        "time_of_day": two_way(F.col("is_night_transaction"), "Night", "Day"),
        "day_type": two_way(F.col("is_weekend"), "Weekend", "Weekday"),
    })
    return fraud_rate(labelled, "time_of_day", "day_type")


def amount_anomalies(txn: DataFrame) -> DataFrame:
    """Amounts above mean + 3 deviations of the table, with the statistics of the anomalies themselves."""
    found = txn.where(F.col(AMOUNT) > _three_sigma(txn))
    return found.select(
        "transaction_id",
        "customer_id",
        "transaction_amount",
        tidy(scalar(found, F.avg(AMOUNT))).alias("avg_amount"),
        tidy(scalar(found, F.stddev_samp(AMOUNT))).alias("stddev_amount"),
        "is_fraud",
        two_way(F.col("is_fraud"), "Confirmed Fraud Anomaly", "Suspicious — Not Flagged as Fraud").alias(
            "anomaly_report"
        ),
    )


def repeat_failures(txn: DataFrame) -> DataFrame:
    return txn.where("is_fraud = 1 AND failed_attempts > 3").groupBy("customer_id").agg(
        F.max("failed_attempts").alias("max_failed_attempts"),
        _rows().alias("txn_count"),
        _frauds().alias("fraud_count"),
    )


def fraud_by_pin(txn: DataFrame) -> DataFrame:
    status = two_way(F.col("pin_changed_recently"), "PIN Changed Recently", "PIN Not Changed")
    return fraud_rate(txn.withColumn("pin_status", status), "pin_status")


def fraud_by_international(txn: DataFrame) -> DataFrame:
    kind = two_way(F.col("is_international"), "International", "Domestic")
    return fraud_rate(txn.withColumn("transaction_type", kind), "transaction_type")


def high_risk(txn: DataFrame) -> DataFrame:
    return txn.where("is_international = 1 AND is_night_transaction = 1 AND failed_attempts > 2")


def risk_ranking(txn: DataFrame) -> DataFrame:
    per_customer = rate_by(
        high_risk(txn), ["customer_id"], "is_fraud", count_as="txn_count", hits_as="fraud_count",
        rate_as="fraud_rate", extra=[F.max("failed_attempts").alias("max_failed")],
    )
    return rank_by_level(per_customer, "fraud_count", "risk_rank")


def high_risk_view(txn: DataFrame) -> DataFrame:
    return high_risk(txn).select(
        "transaction_id", "customer_id", "transaction_date", "transaction_amount", "country",
        "merchant_category", "payment_method", "failed_attempts", "is_fraud",
    )


def country_rank(txn: DataFrame, blocks: int | None = None) -> DataFrame:
    """Customers ranked by spend within their country, however many a country has."""
    spent = txn.groupBy("country", "customer_id").agg(F.round(F.sum(AMOUNT), 6).alias("spent"))
    placed = place_in_blocks(spent, [asc("country"), desc("spent"), asc("customer_id")], blocks)
    ranked = rank_rows(placed, ["country"], "spent", rank_as="country_rank")
    return ranked.select("country", "customer_id", tidy(F.col("spent")).alias("total_amount"), "country_rank")


def top_n_per_group(txn: DataFrame, n: int = 5) -> DataFrame:
    slim = txn.select("merchant_category", "transaction_id", "customer_id", "transaction_amount")
    top = top_k_per_group(slim, n, ["merchant_category"], "transaction_amount", ["transaction_id"], "row_num")
    return top.withColumn("row_num", F.col("row_num").cast("bigint"))


def running_total(txn: DataFrame) -> DataFrame:
    slim = txn.select("transaction_id", "customer_id", "transaction_date", "transaction_amount")
    running = running_by_day(slim, "customer_id", "transaction_date", "transaction_amount", total_as="total")
    return running.withColumn("cumulative_amount", tidy(F.col("total"))).drop("total")


def customer_deciles(txn: DataFrame, tiles: int = 10, blocks: int | None = None) -> DataFrame:
    spent = txn.groupBy("customer_id").agg(F.round(F.sum(AMOUNT), 6).alias("spent"))
    order = [desc("spent"), asc("customer_id")]
    placed = place_in_blocks(spent, order, blocks)
    numbered = number_rows(placed, [], order, number_as="position")
    decile = tile_of(F.col("position"), scalar(placed, _rows()), tiles)
    return numbered.select(
        "customer_id",
        tidy(F.col("spent")).alias("total_amount"),
        decile.alias("decile"),
        decile_tier(decile).alias("customer_tier"),
    )


def executive_fraud_report(txn: DataFrame) -> DataFrame:
    """One row: volume, fraud, the riskiest (country, merchant, payment) group, and who commits fraud."""

    def of_frauds(column: str) -> Column:
        return tidy(F.avg(F.when(F.col("is_fraud") == 1, F.col(column))))

    keys = ["country", "merchant_category", "payment_method"]
    groups = txn.groupBy(*keys).agg(_frauds().alias("frauds"))
    riskiest = top_k(groups, 1, "frauds", keys).select(F.struct(*keys).alias("g")).scalar()
    totals = txn.agg(
        _rows().alias("total_transactions"),
        tidy(F.sum(AMOUNT)).alias("total_transaction_value"),
        tidy(F.avg(AMOUNT)).alias("avg_transaction_amount"),
        _frauds().alias("total_fraud_cases"),
        percent(_frauds(), _rows()).alias("fraud_percentage"),
        of_frauds("credit_score").alias("avg_credit_score_fraudsters"),
        of_frauds("account_balance").alias("avg_balance_fraudsters"),
        of_frauds("failed_attempts").alias("avg_failed_attempts_fraudsters"),
    )
    with_groups = totals.withColumns({
        "top_fraud_type": most_common(txn.where("is_fraud = 1"), "fraud_type"),
        "__g": riskiest,
    })
    return with_groups.select(
        "total_transactions", "total_transaction_value", "avg_transaction_amount", "total_fraud_cases",
        "fraud_percentage", "top_fraud_type",
        F.col("__g.country").alias("highest_risk_country"),
        F.col("__g.merchant_category").alias("highest_risk_merchant"),
        F.col("__g.payment_method").alias("highest_risk_payment"),
        "avg_credit_score_fraudsters", "avg_balance_fraudsters", "avg_failed_attempts_fraudsters",
    )


def daily_fraud_report(txn: DataFrame) -> DataFrame:
    return rate_by(
        txn, ["transaction_date"], "is_fraud", count_as="total_transactions", hits_as="fraud_cases",
        rate_as="fraud_rate", extra=[tidy(F.sum(AMOUNT)).alias("total_amount")],
    )


def suspicious_customers(txn: DataFrame) -> DataFrame:
    risky = txn.where("is_international = 1 AND failed_attempts > 2 AND credit_score < 600")
    return risky.where(F.col(AMOUNT) > _mean_amount(txn)).groupBy("customer_id").agg(
        tidy(F.avg(AMOUNT)).alias("avg_transaction_amount"),
        tidy(F.avg("credit_score")).alias("avg_credit_score"),
        F.max("failed_attempts").alias("max_failed_attempts"),
        _rows().alias("txn_count"),
        _frauds().alias("confirmed_frauds"),
    )


def fraud_summary(txn: DataFrame) -> DataFrame:
    return rate_by(
        txn, ["country", "merchant_category"], "is_fraud", count_as="total_transactions", hits_as="total_fraud",
        rate_as="fraud_rate_pct", extra=[tidy(F.avg(AMOUNT)).alias("avg_amount")],
    )


def fraud_alerts(txn: DataFrame) -> DataFrame:
    """Transactions that meet a rule; the first rule met, in this order, names the alert."""
    international = F.col("is_international") == 1
    rules = [
        (F.col(AMOUNT) > _three_sigma(txn), "High Amount Anomaly"),
        (F.col("failed_attempts") > 3, "Multiple Failed Attempts"),
        (
            international & (F.col("is_night_transaction") == 1) & (F.col("failed_attempts") > 2),
            "International Night Fraud",
        ),
        (
            international & (F.col("credit_score") < 600) & (F.col(AMOUNT) > _mean_amount(txn)),
            "High Risk International",
        ),
    ]
    alert = first_match([(condition, F.lit(name)) for condition, name in rules])
    return txn.select(
        "transaction_id", "customer_id", "transaction_amount", "country", "merchant_category", "failed_attempts",
        "credit_score", "is_international", "is_night_transaction", "is_fraud", alert.alias("alert_type"),
    ).where(F.col("alert_type").isNotNull())


def fraud_daily_summary(txn: DataFrame) -> DataFrame:
    return rate_by(
        fraud_alerts(txn), ["alert_type"], "is_fraud", count_as="total_alerts", hits_as="confirmed_fraud",
        rate_as="fraud_confirmation_rate",
        extra=[tidy(F.avg(AMOUNT)).alias("avg_transaction_amount"), tidy(F.sum(AMOUNT)).alias("total_amount_at_risk")],
    )


def fraud_business_report(txn: DataFrame, k: int = 3) -> DataFrame:
    """The k countries with most frauds, beside the overall fraud count and average amount."""
    frauds = txn.where("is_fraud = 1")
    by_country = txn.groupBy("country").agg(_frauds().alias("fraud_count"))
    return top_k(by_country, k, "fraud_count", ["country"]).select(
        "country",
        "fraud_count",
        scalar(frauds, _rows()).alias("total_fraud"),
        tidy(scalar(frauds, F.avg(AMOUNT))).alias("avg_fraud_amount"),
    )
