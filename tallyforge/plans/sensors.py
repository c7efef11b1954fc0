"""Sensor readings, page views and transaction totals over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.numbers import tidy
from tallyforge.operators.ordered import asc, number_rows, place_in_blocks
from tallyforge.operators.rolling import rolling_stats

# Readings needed before a sensor can alert, and deviations above the mean.
MIN_READINGS, ALERT_DEVIATIONS = 10, 3
HIGH_VALUE = 10_000


def page_view_windows(views: DataFrame, size: str = "5 minutes") -> DataFrame:
    counted = views.groupBy(F.window("ts", size).alias("w"), "page").agg(F.count(F.lit(1)).alias("views"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "page", "views")


def sensor_windows(readings: DataFrame, size: str = "5 minutes") -> DataFrame:
    grouped = readings.groupBy(F.window("ts", size).alias("w"), "sensor_id").agg(
        F.avg("temperature").alias("avg_temp"), F.count(F.lit(1)).alias("reading_count")
    )
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "sensor_id", "avg_temp",
        "reading_count",
    )


def window_versions(readings: DataFrame, batch: str, size: str = "1 hour") -> DataFrame:
    """Every version a window passes through when readings arrive in batches ``batch``.

    Each batch that touches a window makes a version over all readings so far. The batches
    of one window are few, and readings are summed per batch first.
    """
    per_batch = readings.groupBy(F.window("ts", size).alias("w"), "sensor_id", batch).agg(
        F.sum("temperature").alias("t"), F.count(F.lit(1)).alias("n")
    )
    so_far = Window.partitionBy("w", "sensor_id").orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    versions = per_batch.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "sensor_id",
        tidy(F.sum("t").over(so_far) / F.sum("n").over(so_far), 6).alias("avg_temp"),
        F.sum("n").over(so_far).alias("reading_count"),
        F.row_number().over(Window.partitionBy("w", "sensor_id").orderBy(batch)).cast("bigint").alias("version"),
    )
    return versions.withColumn("is_correction", F.col("version") > 1)


def sensor_anomalies(readings: DataFrame, seconds: int = 3600, slots: int = 60) -> DataFrame:
    """Readings above mean + 3 deviations of their sensor's last ``seconds``, itself included."""
    known = readings.where("sensor_id IS NOT NULL AND temperature IS NOT NULL")
    stats = rolling_stats(known, "sensor_id", "ts", "temperature", seconds=seconds, slots=slots)
    threshold = F.col("rolling_avg") + ALERT_DEVIATIONS * F.col("rolling_stddev")
    alerts = stats.where(
        (F.col("rolling_count") >= MIN_READINGS) & (F.col("rolling_stddev") > 0) & (F.col("temperature") > threshold)
    )
    return alerts.select(
        "reading_id",
        "sensor_id",
        "temperature",
        tidy(F.col("rolling_avg"), 3).alias("rolling_avg"),
        tidy(F.col("rolling_stddev"), 3).alias("rolling_stddev"),
        tidy(threshold, 3).alias("threshold"),
        F.col("ts").alias("event_ts"),
    )


def high_value_running_totals(
    transactions: DataFrame, threshold: float = HIGH_VALUE, blocks: int | None = None
) -> DataFrame:
    """For each transaction above ``threshold``: its customer's running total and count.

    Transactions are taken in the order of their id. A customer with a third of all
    transactions is spread over many blocks.
    """
    order = [asc("transaction_id")]
    high = transactions.where(F.col("amount") > threshold).select("customer_id", "transaction_id", "amount")
    placed = place_in_blocks(high, [asc("customer_id"), *order], blocks)
    numbered = number_rows(
        placed, ["customer_id"], order, number_as="transactions_counted", sums={"running": "amount"}
    )
    return numbered.select(
        "customer_id",
        tidy(F.col("running")).alias("running_total"),
        F.col("transaction_id").alias("latest_transaction_id"),
        F.col("amount").alias("latest_amount"),
        "transactions_counted",
    )
