"""``foreachBatch`` sinks. All are DataFrame writes, and all may be retried safely."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.numbers import tidy
from tallyforge.operators.aggregate import rank_by_level
from tallyforge.operators.lookup import lookup
from tallyforge.operators.ordered import asc, number_rows, place_in_blocks
from tallyforge.plans import social
from tallyforge.sources import versions
from tallyforge.sources.messages import merge_records, to_keyed_messages
from tallyforge.sources.updates import current, log_updates
from tallyforge.sources.writers import write_batch, write_dead_letters

Sink = Callable[[DataFrame, int], None]

TOTALS = "total double, transactions bigint"


def land(raw_path: str, dead_letter_path: str) -> Sink:
    """Landing rows to the raw table, invalid ones also to the dead letters."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # two writes read it
        try:
            write_batch(batch, raw_path, batch_id)
            write_dead_letters(batch, dead_letter_path, batch_id)
        finally:
            batch.unpersist()

    return sink


def enrich(
    path: str,
    load_users: Callable[[], DataFrame],
    load_posts: Callable[[], DataFrame],
    ingested_at: Column | None = None,
    *,
    only_valid: bool = False,
) -> Sink:
    """Curated rows; the dimensions are read anew for each batch."""
    when = F.current_timestamp() if ingested_at is None else ingested_at

    def curated(batch: DataFrame) -> DataFrame:
        return social.enrich_events(batch, load_users(), load_posts(), when, only_valid=only_valid)

    return log_updates(path, curated)


def trends(path: str) -> Sink:
    return log_updates(path, stamped_as="calculated_at")


def sensor_versions(path: str) -> Sink:
    """Window averages; ``updates.current`` and ``updates.history`` are the two tables over it."""
    return log_updates(path, stamped_as="recorded_at")


def sentiments(path: str) -> Sink:
    return log_updates(path, stamped_as="processed_at")


def keep_viral(path: str, threshold: int = social.VIRAL_LIKES) -> Sink:
    return log_updates(path, lambda batch: batch.where(F.col("like_count") >= threshold), stamped_as="detected_at")


def rank_users(path: str, keep: int = 2) -> Sink:
    """Rank all users of a complete-mode batch and publish the table (``versions.read``); ``keep`` versions stay in storage."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        ranked = rank_by_level(batch, "total_engagement", "rank").withColumn("calculated_at", F.current_timestamp())
        versions.publish(ranked, path, batch_id, keep=keep)

    return sink


def merge(path: str, order: str, *, size: int = 1000) -> Sink:
    """JSON arrays of at most ``size`` records; the trigger interval bounds their age."""
    return log_updates(path, lambda batch: merge_records(batch, order, size=size))


def running_totals(
    path: str, totals_path: str, *, arrival: Sequence[str], snapshot_every: int = 20,
    publish: Callable[[DataFrame], None] | None = None,
) -> Sink:
    """Running total and count per customer, one row per transaction, in the order of arrival.

    ``arrival`` names the columns that give this order, such as the message's partition and offset; the id breaks
    ties. The totals do not depend on how the stream was cut into batches. ``state.running_totals`` does the same with
    keyed state; this form spreads a customer who fills a batch over many tasks.

    Sums within the batch come from the block-wise running sum, so one customer may fill
    the batch. What a customer brings from earlier batches lies in a table of totals: each
    batch adds the customers it touched, and every ``snapshot_every`` batches all of them,
    so no batch reads further back than the last snapshot. A retried batch reads only
    batches before it and replaces what it wrote.
    """

    def totals_before(spark: SparkSession, batch_id: int) -> DataFrame:
        since = (batch_id - 1) // snapshot_every * snapshot_every
        rows = spark.read.schema(f"customer_id string, {TOTALS}, batch_id bigint").parquet(totals_path)
        rows = rows.where(F.col("batch_id").between(since, batch_id - 1))
        return current(rows, ["customer_id"]).drop("batch_id", "version")

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, order = batch.sparkSession, [*map(asc, arrival), asc("transaction_id")]
        rows = batch.withColumn("customer_id", F.col("customer_id").cast("string"))
        placed = place_in_blocks(rows, [asc("customer_id"), *order])
        inside = number_rows(placed, ["customer_id"], order, number_as="n", sums={"running": "amount"})
        if batch_id > 0:
            earlier = totals_before(spark, batch_id)
        else:
            earlier = spark.createDataFrame([], f"customer_id string, {TOTALS}")
        carried = lookup(inside, earlier, "customer_id", {"total": "before", "transactions": "count_before"})
        running = F.col("running") + F.coalesce("before", F.lit(0.0))
        counted = F.col("n") + F.coalesce("count_before", F.lit(0))
        shown = carried.select(
            "customer_id",
            tidy(running).alias("running_total"),
            F.col("transaction_id").alias("latest_transaction_id"),
            F.col("amount").alias("latest_amount"),
            counted.alias("transactions_counted"),
        )
        write_batch(shown, path, batch_id)

        added = placed.groupBy("customer_id").agg(
            F.sum("amount").alias("total"), F.count(F.lit(1)).alias("transactions")
        )
        both = added.withColumn("touched", F.lit(True)).unionByName(earlier.withColumn("touched", F.lit(False)))
        whole = both.groupBy("customer_id").agg(
            F.sum("total").alias("total"),
            F.sum("transactions").alias("transactions"),
            F.max("touched").alias("touched"),
        )
        kept = whole if batch_id % snapshot_every == 0 else whole.where("touched")
        write_batch(kept.drop("touched"), totals_path, batch_id)
        if publish:
            publish(to_keyed_messages(spark.read.parquet(f"{path}/batch_id={batch_id}"), "customer_id"))

    return sink


def alerts(path: str, publish: Callable[[DataFrame], None] | None = None) -> Sink:
    """Alerts of ``state.sensor_alerts`` with the time of detection; ``publish`` receives them as keyed messages."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumn("detected_at", F.current_timestamp()), path, batch_id)
        if publish:
            publish(to_keyed_messages(batch.sparkSession.read.parquet(f"{path}/batch_id={batch_id}"), "sensor_id"))

    return sink


def readings(path: str) -> Sink:
    """Readings with an id and the time of arrival, by day of their event time."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        stored = batch.where("sensor_id IS NOT NULL AND temperature IS NOT NULL").withColumns({
            "reading_id": F.xxhash64("sensor_id", "ts", "temperature"), "ingested_at": F.current_timestamp(), "event_date": F.to_date("ts")})
        write_batch(stored, path, batch_id, "event_date")

    return sink
