"""Rule scores and classes. Every rule is a Column, so a score is one projection."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bands import first_match
from .numbers import flag

# Services counted by the adoption score and named in bundles.
SERVICES = [
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]
NO_SERVICES = "No Services"

# Lowest engine score of each risk tier.
RISK_TIERS = [(9, "Critical"), (6, "High"), (3, "Medium")]
RISK_TIER_OTHER = "Low"


def total(parts: list[Column]) -> Column:
    return reduce(add, parts)


def contract_points(contract: Column) -> Column:
    return first_match([(contract == "Month-to-month", 3), (contract == "One year", 1)], 0)


def tenure_points(tenure: Column) -> Column:
    return first_match([(tenure <= 12, 3), (tenure <= 24, 2), (tenure <= 48, 1)], 0)


def churn_risk_score() -> Column:
    """0-10 points from contract, tenure, tech support and online security."""
    return total(
        [
            contract_points(F.col("Contract")),
            tenure_points(F.col("tenure")),
            2 * flag(F.col("TechSupport") == "No"),
            2 * flag(F.col("OnlineSecurity") == "No"),
        ]
    )


def churn_engine_score() -> Column:
    """The churn score plus a point each for electronic checks and for seniors (0-12)."""
    return total(
        [
            churn_risk_score(),
            flag(F.col("PaymentMethod") == "Electronic check"),
            flag(F.col("SeniorCitizen") == 1),
        ]
    )


def risk_tier(score: Column) -> Column:
    return first_match([(score >= low, F.lit(name)) for low, name in RISK_TIERS], RISK_TIER_OTHER)


def mart_risk_score() -> Column:
    """0-7 points on the staged (snake case) columns."""
    return total(
        [
            2 * flag(F.col("contract") == "Month-to-month"),
            flag(F.col("internet_service") == "Fiber optic"),
            flag(F.col("online_security") == "No"),
            flag(F.col("tech_support") == "No"),
            flag(F.col("payment_method") == "Electronic check"),
            flag(F.col("tenure") < 12),
        ]
    )


def adoption_score(services: list[str] = SERVICES) -> Column:
    return total([flag(F.col(name) == "Yes") for name in services])


def bundle_label(services: list[str] = SERVICES) -> Column:
    """Subscribed services joined by ``+``."""
    taken = F.concat_ws("+", *[F.when(F.col(name) == "Yes", F.lit(name)) for name in services])
    return F.coalesce(F.nullif(taken, F.lit("")), F.lit(NO_SERVICES))


def risk_class(amount: Column, credit_score: Column, failed_attempts: Column) -> Column:
    """high / medium / low. An unknown input meets no rule of its own."""
    return first_match(
        [
            ((amount > 10000) | (credit_score < 500) | (failed_attempts > 3), F.lit("high")),
            ((amount > 5000) | (credit_score < 650), F.lit("medium")),
        ],
        "low",
    )
