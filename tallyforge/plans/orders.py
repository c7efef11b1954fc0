"""Order reports: best customers per city, risk classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.numbers import tidy
from tallyforge.functions.scores import risk_class
from tallyforge.operators.aggregate import top_rank_per_group


def city_top_customers(orders: DataFrame, customers: DataFrame, k: int = 5) -> DataFrame:
    """Customers ranked k or better by spend in their city.

    Orders are summed per customer before the join, so a customer with a third of all
    orders reaches it as one row.
    """
    spent = orders.groupBy("customer_id").agg(F.sum("amount").alias("spent"))
    per_customer = (
        spent.join(customers, "customer_id")
        .groupBy("customer_id", "name", "city")
        .agg(F.round(F.sum("spent"), 6).alias("spent"))
    )
    ranked = top_rank_per_group(per_customer, k, ["city"], "spent", "rank")
    return ranked.select(
        "customer_id", "name", "city", tidy(F.col("spent")).alias("total_spend"), F.col("rank").cast("bigint").alias("rank")
    )


def classify(records: DataFrame) -> DataFrame:
    level = risk_class(F.col("amount"), F.col("credit_score"), F.col("failed_attempts"))
    return records.withColumn("risk_level", level)


def risk_classify(records: DataFrame) -> DataFrame:
    return classify(records).select("id", "customer_id", "amount", "credit_score", "failed_attempts", "risk_level")


def risk_route_counts(records: DataFrame) -> DataFrame:
    return classify(records).groupBy("risk_level").agg(F.count(F.lit(1)).alias("records"))
