"""Fraud reports that live on: a view, and a stored table refreshed for changed days only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.sources.writers import refresh_partitions, write_partitioned as reload_partitioned

from .fraud import daily_fraud_report, high_risk_view


def create_high_risk_view(txn: DataFrame, name: str = "vw_high_risk_transactions") -> None:
    """Register the high-risk transactions for SQL users of this session."""
    high_risk_view(txn).createOrReplaceTempView(name)


def refresh_daily_report(txn: DataFrame, path: str, changed_days: DataFrame | None = None) -> None:
    """Recompute the report for the days in ``changed_days`` (column ``transaction_date``), or for all."""
    if changed_days is None:
        reload_partitioned(daily_fraud_report(txn), path, "transaction_date")
        return
    days = changed_days.select("transaction_date").distinct()
    report = daily_fraud_report(txn.join(days, "transaction_date", "left_semi"))
    # a day without transactions gets a folder without rows in place of its old one
    emptied = days.join(report.select("transaction_date"), "transaction_date", "left_anti")
    refresh_partitions(report.unionByName(emptied, allowMissingColumns=True), path, "transaction_date")


def stored_daily_report(spark: SparkSession, path: str) -> DataFrame:
    """The stored report; days that were emptied have no row."""
    return spark.read.parquet(path).where("total_transactions IS NOT NULL")
