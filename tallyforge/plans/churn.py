"""Telecom-churn reports over one customer table (columns as delivered)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.bands import tenure_bin
from tallyforge.functions.numbers import flag, number_or_null, number_or_zero, percent, tidy
from tallyforge.functions.scores import (
    SERVICES,
    adoption_score,
    bundle_label,
    churn_engine_score,
    churn_risk_score,
    risk_tier,
)
from tallyforge.operators.aggregate import rate_by, scalar, stack_dimensions, top_k
from tallyforge.operators.ordered import asc, desc, number_rows, place_in_blocks

MONTHLY = "MonthlyCharges"


def has_churned() -> Column:
    return F.col("Churn") == "Yes"


def lifetime_value() -> Column:
    return F.col(MONTHLY) * F.col("tenure")


def _rows() -> Column:
    return F.count(F.lit(1))


def _churned() -> Column:
    return F.sum(flag(has_churned())).cast("bigint")


def _churn_rate() -> Column:
    return percent(_churned(), _rows())


def churn_rate(customers: DataFrame, *keys: str) -> DataFrame:
    """Only the rate per group."""
    marked = customers.withColumn("__churned", flag(has_churned()))
    return rate_by(marked, keys, "__churned", count_as="n", hits_as=None, rate_as="churn_rate").drop("n")


def with_numeric_charges(customers: DataFrame) -> DataFrame:
    """``TotalCharges`` as a number; blank means a new customer, hence 0."""
    return customers.withColumn("TotalCharges", number_or_zero(F.col("TotalCharges")))


def total_charges_fix(customers: DataFrame) -> DataFrame:
    """How many ``TotalCharges`` were no number, and what the column holds once they are 0."""
    parsed, filled = number_or_null(F.col("TotalCharges")), number_or_zero(F.col("TotalCharges"))
    return customers.agg(
        _rows().alias("total_rows"),
        F.sum(flag(parsed.isNull())).cast("bigint").alias("invalid_count"),
        F.sum(flag(filled.isNull())).cast("bigint").alias("remaining_nulls"),
        tidy(F.sum(filled)).alias("total_charges"),
    )


def charge_discrepancy(customers: DataFrame, limit_pct: float = 10.0) -> DataFrame:
    """Customers whose total differs from monthly x tenure by more than ``limit_pct``."""
    gap = F.abs(F.col("TotalCharges") - F.col("expected_total")) / (F.col("expected_total") + 1) * 100.0
    return (
        with_numeric_charges(customers)
        .select("customerID", "tenure", "MonthlyCharges", "TotalCharges", lifetime_value().alias("expected_total"))
        .withColumn("diff_percentage", gap)
        .where(F.col("diff_percentage") > limit_pct)
        .withColumns({
            "expected_total": tidy(F.col("expected_total"), 6),
            "diff_percentage": tidy(F.col("diff_percentage"), 6),
        })
    )


def churn_by_demographics(customers: DataFrame) -> DataFrame:
    stacked = stack_dimensions(customers, ["gender", "SeniorCitizen", "Partner", "Dependents"], ["Churn"])
    return churn_rate(stacked, "dimension", "value")


def churn_by_segment(customers: DataFrame) -> DataFrame:
    binned = customers.withColumns({"tenure_segment": tenure_bin(F.col("tenure")), "__churned": flag(has_churned())})
    return rate_by(
        binned.where(F.col("tenure_segment").isNotNull()), ["tenure_segment"], "__churned",
        count_as="customer_count", hits_as="churned", rate_as="churn_rate", places=6,
    )


def churn_profiles(customers: DataFrame, support: int = 30, k: int = 10) -> DataFrame:
    keys = ["Contract", "PaymentMethod", "InternetService"]
    marked = customers.withColumn("__churned", flag(has_churned()))
    profiles = rate_by(
        marked, keys, "__churned", count_as="customer_count", hits_as="churned", rate_as="churn_rate"
    )
    return top_k(profiles.where(F.col("customer_count") >= support), k, "churn_rate", keys)


def clv_comparison(customers: DataFrame) -> DataFrame:
    return customers.groupBy("Churn").agg(
        _rows().alias("customer_count"),
        tidy(F.avg(lifetime_value())).alias("avg_clv"),
        tidy(F.avg("tenure")).alias("avg_tenure"),
        tidy(F.avg(MONTHLY)).alias("avg_monthly"),
    )


def churn_by_risk_score(customers: DataFrame) -> DataFrame:
    return churn_rate(customers.withColumn("risk_score", churn_risk_score()), "risk_score")


def annual_loss(customers: DataFrame) -> DataFrame:
    monthly = F.sum(F.when(has_churned(), F.col(MONTHLY)))
    return customers.agg(tidy(monthly).alias("monthly_loss"), tidy(monthly * 12).alias("annual_loss"))


def _by_revenue(customers: DataFrame, blocks: int | None) -> tuple[DataFrame, DataFrame]:
    """Paying customers placed by descending revenue, and numbered with running revenue."""
    order = [desc("TotalCharges"), asc("customerID")]
    paying = with_numeric_charges(customers).select("customerID", "TotalCharges").where("TotalCharges > 0")
    placed = place_in_blocks(paying, order, blocks)
    numbered = number_rows(placed, [], order, number_as="position", sums={"running": "TotalCharges"})
    return placed, numbered


def pareto_curve(customers: DataFrame, blocks: int | None = None) -> DataFrame:
    placed, numbered = _by_revenue(customers, blocks)
    return numbered.select(
        "customerID",
        "TotalCharges",
        tidy(F.col("running")).alias("cumulative_revenue"),
        percent(F.col("running"), scalar(placed, F.sum("TotalCharges")), 6).alias("cumulative_pct"),
    )


def pareto_summary(customers: DataFrame, top_share: float = 0.20, blocks: int | None = None) -> DataFrame:
    """What the top ``top_share`` of paying customers contribute to revenue."""
    placed, numbered = _by_revenue(customers, blocks)
    size = scalar(placed, _rows())
    cutoff = F.floor(size * F.lit(top_share))
    in_top = F.col("position") <= cutoff
    sums = numbered.agg(
        _rows().alias("total_customers"),
        F.sum(flag(in_top)).cast("bigint").alias("top_customers"),
        F.sum(F.when(in_top, F.col("TotalCharges"))).alias("top"),
        F.sum("TotalCharges").alias("whole"),
    )
    return sums.select(
        "total_customers",
        "top_customers",
        tidy(F.col("top")).alias("top_revenue"),
        tidy(F.col("whole")).alias("total_revenue"),
        percent(F.col("top"), F.col("whole")).alias("top_revenue_pct"),
    )


def arpu(customers: DataFrame) -> DataFrame:
    stacked = stack_dimensions(customers, ["Contract", "InternetService", "PaymentMethod"], ["MonthlyCharges"])
    return stacked.groupBy("dimension", "value").agg(tidy(F.avg(MONTHLY)).alias("arpu"))


def first_quartile(df: DataFrame, column: str) -> Column:
    """Interpolated 25th percentile of a low-cardinality column, from its value counts."""
    counts = df.groupBy(column).agg(_rows().alias("n"))
    return scalar(counts, F.percentile(column, 0.25, F.col("n")))


def revenue_leakage(customers: DataFrame) -> DataFrame:
    """Churned customers with above-average charges and first-quartile tenure."""
    leaking = with_numeric_charges(customers).where(
        (F.col(MONTHLY) > scalar(customers, F.avg(MONTHLY)))
        & (F.col("tenure") <= first_quartile(customers, "tenure"))
        & has_churned()
    )
    return leaking.select("customerID", "Contract", "InternetService", "MonthlyCharges", "tenure", "TotalCharges")


def revenue_leakage_summary(customers: DataFrame) -> DataFrame:
    sums = revenue_leakage(customers).agg(
        _rows().alias("leakage_customers"), F.coalesce(tidy(F.sum(MONTHLY)), F.lit(0.0)).alias("monthly_revenue_lost")
    )
    return sums.select(
        tidy(scalar(customers, F.avg(MONTHLY))).alias("high_charge_threshold"),
        F.floor(first_quartile(customers, "tenure")).cast("bigint").alias("low_tenure_threshold"),
        "leakage_customers",
        "monthly_revenue_lost",
    )


def _high_charge(customers: DataFrame, deviations: float) -> Column:
    return scalar(customers, F.avg(MONTHLY) + deviations * F.stddev_samp(MONTHLY))


def high_payers(customers: DataFrame, deviations: float = 1.5) -> DataFrame:
    return customers.where(F.col(MONTHLY) > _high_charge(customers, deviations)).select(
        "customerID", "MonthlyCharges", "Contract", "InternetService", "Churn"
    )


def high_payer_summary(customers: DataFrame, deviations: float = 1.5) -> DataFrame:
    sums = high_payers(customers, deviations).agg(
        _rows().alias("high_paying_customers"), _churn_rate().alias("churn_rate")
    )
    return sums.select(
        tidy(scalar(customers, F.avg(MONTHLY))).alias("mean_charge"),
        tidy(scalar(customers, F.stddev_samp(MONTHLY))).alias("std_charge"),
        tidy(_high_charge(customers, deviations)).alias("threshold"),
        "high_paying_customers",
        "churn_rate",
    )


def churn_by_combo(customers: DataFrame) -> DataFrame:
    return churn_rate(customers, "InternetService", "TechSupport")


def service_effect(customers: DataFrame) -> DataFrame:
    """Churn with and without each service. Customers who cannot have it are on neither side."""
    stacked = stack_dimensions(customers, SERVICES, ["Churn"], name_as="service", value_as="taken")

    def rate_where(taken: str) -> Column:
        side = F.col("taken") == taken
        return percent(F.sum(flag(side & has_churned())), F.sum(flag(side)))

    rates = stacked.groupBy("service").agg(
        rate_where("Yes").alias("churn_with"), rate_where("No").alias("churn_without")
    )
    return rates.withColumn("churn_reduction", tidy(F.col("churn_without") - F.col("churn_with")))


def churn_by_adoption(customers: DataFrame) -> DataFrame:
    return churn_rate(customers.withColumn("adoption_score", adoption_score()), "adoption_score")


def fiber_cohort(customers: DataFrame) -> DataFrame:
    cohort = customers.where("InternetService = 'Fiber optic' AND TechSupport = 'No' AND OnlineSecurity = 'No'")
    return cohort.agg(
        _rows().alias("matching_customers"),
        F.coalesce(_churned(), F.lit(0)).alias("churned"),
        _churn_rate().alias("churn_rate"),
    )


def bundle_value(customers: DataFrame, support: int = 30, k: int = 10) -> DataFrame:
    bundles = (
        with_numeric_charges(customers)
        .withColumn("bundle", bundle_label())
        .groupBy("bundle")
        .agg(
            _rows().alias("customer_count"),
            tidy(F.avg(MONTHLY)).alias("avg_monthly"),
            _churn_rate().alias("churn_rate"),
            tidy(F.avg("TotalCharges")).alias("avg_clv"),
        )
    )
    return top_k(bundles.where(F.col("customer_count") >= support), k, "avg_clv", ["bundle"])


def churn_features(customers: DataFrame) -> DataFrame:
    """Feature matrix: one row per customer, numbers only, with the label last."""
    yes = {
        "has_partner": "Partner",
        "has_dependents": "Dependents",
        "has_phone": "PhoneService",
        "has_security": "OnlineSecurity",
        "has_techsupport": "TechSupport",
        "is_paperless": "PaperlessBilling",
    }
    return with_numeric_charges(customers).select(
        "customerID",
        "tenure",
        F.col(MONTHLY).alias("monthly_charges"),
        F.col("TotalCharges").alias("total_charges"),
        F.round(lifetime_value(), 6).alias("clv"),
        F.col("SeniorCitizen").alias("is_senior"),
        *[flag(F.col(source) == "Yes").alias(name) for name, source in yes.items()],
        flag(F.col("Contract") == "Month-to-month").alias("contract_monthly"),
        flag(F.col("Contract") == "One year").alias("contract_yearly"),
        churn_risk_score().alias("risk_score"),
        flag(has_churned()).alias("churn"),
    )


def retention_kpis(customers: DataFrame) -> DataFrame:
    return customers.groupBy("Contract").agg(
        _rows().alias("total_customers"),
        _churned().alias("churned"),
        F.sum(flag(~has_churned())).cast("bigint").alias("retained"),
        _churn_rate().alias("churn_rate"),
        tidy(F.avg("tenure")).alias("avg_tenure"),
        tidy(F.avg(lifetime_value())).alias("avg_clv"),
    )


def churn_by_risk_tier(customers: DataFrame) -> DataFrame:
    tiered = customers.withColumns({
        "churn_risk": risk_tier(churn_engine_score()), "__churned": flag(has_churned())
    })
    return rate_by(
        tiered, ["churn_risk"], "__churned", count_as="customer_count", hits_as=None, rate_as="churn_rate"
    )
