"""Churn star schema: staging -> features -> dimensions and fact -> KPI mart."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.bands import tenure_step
from tallyforge.functions.numbers import flag, number_or_null, tidy
from tallyforge.functions.scores import mart_risk_score
from tallyforge.operators.aggregate import rate_by
from tallyforge.operators.checks import run_table_tests


def stg_churn(customers: DataFrame, scale: int | None = None) -> DataFrame:
    """Snake case names, Yes/No as 1/0, charges as a number (NULL if blank).

    ``scale=0`` rounds charges to whole units, as a warehouse NUMBER without scale does.
    """
    same = {
        "phone_service": "PhoneService",
        "multiple_lines": "MultipleLines",
        "internet_service": "InternetService",
        "online_security": "OnlineSecurity",
        "online_backup": "OnlineBackup",
        "device_protection": "DeviceProtection",
        "tech_support": "TechSupport",
        "streaming_tv": "StreamingTV",
        "streaming_movies": "StreamingMovies",
    }
    return customers.select(
        F.col("customerID").alias("customer_id"),
        "gender",
        F.col("SeniorCitizen").alias("is_senior"),
        flag(F.col("Partner") == "Yes").alias("has_partner"),
        flag(F.col("Dependents") == "Yes").alias("has_dependents"),
        "tenure",
        F.col("Contract").alias("contract"),
        flag(F.col("PaperlessBilling") == "Yes").alias("is_paperless"),
        F.col("PaymentMethod").alias("payment_method"),
        F.col("MonthlyCharges").alias("monthly_charges"),
        number_or_null(F.col("TotalCharges"), scale).alias("total_charges"),
        *[F.col(source).alias(name) for name, source in same.items()],
        flag(F.col("Churn") == "Yes").alias("is_churned"),
    )


def int_customer_features(staged: DataFrame) -> DataFrame:
    return staged.withColumns({
        "clv": F.round(F.col("monthly_charges") * F.col("tenure"), 6),
        "tenure_segment": tenure_step(F.col("tenure")),
        "risk_score": mart_risk_score(),
    })


def dim_customers(features: DataFrame) -> DataFrame:
    return features.select(
        "customer_id", "gender", "is_senior", "has_partner", "has_dependents", "tenure", "tenure_segment",
        "contract", "payment_method", "is_paperless", "monthly_charges", "total_charges", "clv",
    )


def dim_services(features: DataFrame) -> DataFrame:
    return features.select(
        "customer_id", "phone_service", "multiple_lines", "internet_service", "online_security", "online_backup",
        "device_protection", "tech_support", "streaming_tv", "streaming_movies",
    )


def fct_churn(features: DataFrame) -> DataFrame:
    return features.select(
        "customer_id", "is_churned", "monthly_charges", "total_charges", "clv", "tenure", "risk_score",
        "tenure_segment", "contract",
    )


def mart_churn_kpis(fact: DataFrame) -> DataFrame:
    lost = F.sum(F.when(F.col("is_churned") == 1, F.col("monthly_charges") * 12).otherwise(0.0))
    return rate_by(
        fact, ["contract"], "is_churned", count_as="total_customers", hits_as="churned_customers",
        rate_as="churn_rate_pct",
        extra=[
            tidy(F.avg("monthly_charges")).alias("avg_monthly_charges"),
            tidy(F.avg("clv")).alias("avg_clv"),
            tidy(lost).alias("annual_revenue_lost"),
            tidy(F.avg("risk_score")).alias("avg_risk_score"),
            tidy(F.avg("tenure"), 1).alias("avg_tenure_months"),
        ],
    )


def churn_loss_total(kpis: DataFrame) -> DataFrame:
    return kpis.agg(tidy(F.sum("annual_revenue_lost")).alias("total_churn_loss"))


# Tests declared per model as (unique key, columns that must not be null).
MODEL_TESTS = {
    "stg_churn": ("customer_id", ["customer_id", "is_churned"]),
    "int_customer_features": ("customer_id", ["customer_id"]),
    "dim_customers": ("customer_id", ["customer_id"]),
    "dim_services": ("customer_id", ["customer_id"]),
    "fct_churn": ("customer_id", ["customer_id", "is_churned"]),
    "mart_churn_kpis": ("contract", ["contract"]),
}

# Each model with the model it reads, in dependency order.
MODELS: list[tuple[str, str, Callable[[DataFrame], DataFrame]]] = [
    ("stg_churn", "raw_churn", stg_churn),
    ("int_customer_features", "stg_churn", int_customer_features),
    ("dim_customers", "int_customer_features", dim_customers),
    ("dim_services", "int_customer_features", dim_services),
    ("fct_churn", "int_customer_features", fct_churn),
    ("mart_churn_kpis", "fct_churn", mart_churn_kpis),
]
STORED = {"dim_customers", "dim_services", "fct_churn", "mart_churn_kpis"}


def models(customers: DataFrame) -> dict[str, DataFrame]:
    """All models as DataFrames, none of them computed yet."""
    built = {"raw_churn": customers}
    for name, reads, make in MODELS:
        built[name] = make(built[reads])
    return built


def data_tests(built: dict[str, DataFrame]) -> DataFrame:
    """(model, column, test, failures) for every declared test."""
    results = [run_table_tests(name, built[name], *tests) for name, tests in MODEL_TESTS.items()]
    return reduce(DataFrame.unionByName, results)


def materialize(spark: SparkSession, customers: DataFrame, path: str) -> dict[str, DataFrame]:
    """Build the mart: staging and features as views, dimensions, fact and KPIs as Parquet tables."""
    built = {"raw_churn": customers}
    for name, reads, make in MODELS:
        frame = make(built[reads])
        if name in STORED:
            frame.write.mode("overwrite").parquet(f"{path}/{name}")
            frame = spark.read.parquet(f"{path}/{name}")
        frame.createOrReplaceTempView(name)
        built[name] = frame
    return built
