"""Streaming jobs: the batch builders of ``plans`` behind a watermark.

Each function takes a stream with the event time ``ts`` (a ``timestamp``) and returns the
stream to be written. Sources and sinks are chosen by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyforge.plans import sensors, social

# How long late rows are waited for, per source, and trigger intervals.
PAGE_VIEW_DELAY = SENSOR_DELAY = "10 minutes"
SOCIAL_DELAY = "5 minutes"
LANDING_TRIGGER, CURATED_TRIGGER, ANALYTICS_TRIGGER = "10 seconds", "15 seconds", "30 seconds"


def page_views(stream: DataFrame, delay: str = PAGE_VIEW_DELAY) -> DataFrame:
    return sensors.page_view_windows(stream.withWatermark("ts", delay))


def sensor_windows(stream: DataFrame, delay: str = SENSOR_DELAY, size: str = "5 minutes") -> DataFrame:
    return sensors.sensor_windows(stream.withWatermark("ts", delay), size)


def trending(stream: DataFrame, delay: str = SOCIAL_DELAY) -> DataFrame:
    """One stateful aggregation per window size, so that each one's state is evicted."""
    return social.trending_hashtags(stream.withWatermark("ts", delay))


def likes(stream: DataFrame, delay: str = SOCIAL_DELAY) -> DataFrame:
    """Like counts per post and window; the sink keeps the viral ones."""
    return social.like_windows(stream.withWatermark("ts", delay))


def engagement(stream: DataFrame, **options) -> DataFrame:
    """All-time scores (complete mode): the state holds one row per user."""
    return social.engagement(stream, **options)


def landing(stream: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    return social.raw_events(stream, F.current_timestamp() if ingested_at is None else ingested_at)


def sentiments(stream: DataFrame) -> DataFrame:
    return social.comment_sentiment(stream)


def high_value(stream: DataFrame, threshold: float = sensors.HIGH_VALUE, arrival: Sequence[str] = ()) -> DataFrame:
    """Transactions above ``threshold``, for the running totals of :func:`sinks.running_totals`; ``arrival`` stays."""
    customer = F.coalesce(F.col("customer_id").cast("string"), F.lit("UNKNOWN")).alias("customer_id")
    return stream.where(F.col("amount") > threshold).select(customer, "transaction_id", "amount", *arrival)


def start(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None] | str,
    checkpoint: str,
    *,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Start a job. ``sink`` is a batch function or a format name such as ``console``.

    ``every`` is a trigger interval; without it the job works off what is there and stops.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return (writer.format(sink) if isinstance(sink, str) else writer.foreachBatch(sink)).start()
