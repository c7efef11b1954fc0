"""Social events: landing, enrichment, trends, viral posts, influence, sentiment.

The builders take batch and streaming frames alike; event time is the column ``ts``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.events import ENGAGEMENT_WEIGHTS, engagement_points, validation_errors
from tallyforge.functions.numbers import blank_to_null, flag, nan_to_null, percent, tidy
from tallyforge.functions.text import sentiment
from tallyforge.operators.aggregate import rank_by_level, scalar, share_by, top_k
from tallyforge.operators.lookup import lookup
from tallyforge.sources.messages import parse_tags

# Window sizes of the trending table, viral window and threshold.
TREND_SIZES = ["1 minute", "5 minutes", "15 minutes"]
VIRAL_WINDOW, VIRAL_LIKES = "5 minutes", 50


def _rows() -> Column:
    return F.count(F.lit(1))


def _or_blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def validate_events(events: DataFrame) -> DataFrame:
    """Each event with ``is_valid`` and the list of broken rules (NULL if none)."""
    return events.withColumn("validation_errors", blank_to_null(validation_errors())).withColumn(
        "is_valid", F.col("validation_errors").isNull()
    )


def raw_events(events: DataFrame, ingested_at: Column) -> DataFrame:
    """Landing rows: every event, valid or not, with blanks and NaN removed."""
    payload = [F.col("raw_payload")] if "raw_payload" in events.columns else []
    return validate_events(events).select(
        _or_blank("event_id"),
        _or_blank("event_type"),
        _or_blank("user_id"),
        *[blank_to_null(F.col(c)).alias(c) for c in ("post_id", "target_user_id")],
        F.to_json(F.coalesce("hashtags", F.array().cast("array<string>"))).alias("hashtags"),
        *[blank_to_null(F.col(c)).alias(c) for c in ("comment_text", "content_type")],
        *[nan_to_null(F.col(c)).alias(c) for c in ("video_duration_sec", "watch_time_sec")],
        *payload,
        F.coalesce(F.col("ts"), ingested_at).alias("event_timestamp"),
        ingested_at.alias("ingested_at"),
        "is_valid",
        "validation_errors",
    )


def enrich_events(
    events: DataFrame, user_dim: DataFrame, post_dim: DataFrame, ingested_at: Column, *, only_valid: bool = False
) -> DataFrame:
    """Curated rows: user name and type, content type and tags, with defaults for the unknown.

    A post's content type overrides the event's; an event's tags override the post's.
    """
    if only_valid:
        events = validate_events(events).where("is_valid")
    with_user = lookup(events, user_dim, "user_id", {"username": "username", "user_type": "user_type"})
    joined = lookup(with_user, post_dim, "post_id", {"content_type": "post_type", "hashtags": "post_tags"})
    tags = F.coalesce(
        F.col("hashtags"), parse_tags(F.col("post_tags")), F.array().cast("array<string>")
    )
    return joined.select(
        _or_blank("event_id"),
        _or_blank("event_type"),
        _or_blank("user_id"),
        F.coalesce("username", F.lit("unknown")).alias("username"),
        F.coalesce("user_type", F.lit("regular")).alias("user_type"),
        blank_to_null(F.col("post_id")).alias("post_id"),
        F.coalesce(blank_to_null(F.col("post_type")), blank_to_null(F.col("content_type"))).alias("content_type"),
        F.to_json(tags).alias("hashtags"),
        blank_to_null(F.col("comment_text")).alias("comment_text"),
        *[nan_to_null(F.col(c)).alias(c) for c in ("video_duration_sec", "watch_time_sec")],
        F.coalesce(F.col("ts"), ingested_at).alias("event_timestamp"),
        ingested_at.alias("ingested_at"),
    )


def comment_sentiment(events: DataFrame) -> DataFrame:
    comments = events.where((F.col("event_type") == "COMMENT") & F.col("comment_text").isNotNull())
    return comments.select(
        "event_id", "user_id", "post_id", "comment_text", sentiment(F.col("comment_text")).alias("sentiment"),
        F.col("ts").alias("event_timestamp"),
    )


def hashtag_mentions(events: DataFrame) -> DataFrame:
    """One row per mention."""
    return events.where(F.col("hashtags").isNotNull()).select("ts", F.explode("hashtags").alias("hashtag"))


def count_mentions(mentions: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Mentions per tag and window; a ``slide`` shorter than ``size`` gives overlapping windows."""
    span = F.window("ts", size, slide) if slide else F.window("ts", size)
    return mentions.groupBy(span.alias("w"), "hashtag").agg(_rows().alias("mention_count")).select(
        "hashtag", F.lit(size).alias("window_size"), F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"), "mention_count",
    )


def trending_hashtags(events: DataFrame, sizes: Sequence[str] = TREND_SIZES) -> DataFrame:
    """Mentions per tag for each window size, one aggregation per size (batch or stream)."""
    mentions = hashtag_mentions(events)
    return reduce(DataFrame.unionByName, [count_mentions(mentions, size) for size in sizes])


def trending_rollup(events: DataFrame, sizes: Sequence[str] = TREND_SIZES) -> DataFrame:
    """The same rows for batch input: events are counted once, by the first (finest) size.

    The other sizes must be multiples of it; they sum those counts, which all branches
    share through one shuffle.
    """
    finest = count_mentions(hashtag_mentions(events), sizes[0])

    def rolled(size: str) -> DataFrame:
        span = F.window("window_start", size).alias("w")
        return finest.groupBy(span, "hashtag").agg(F.sum("mention_count").alias("mention_count")).select(
            "hashtag", F.lit(size).alias("window_size"), F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"), "mention_count",
        )

    return reduce(DataFrame.unionByName, [finest, *[rolled(size) for size in sizes[1:]]])


def sliding_hashtags(events: DataFrame, size: str = "15 minutes", slide: str = "5 minutes") -> DataFrame:
    return count_mentions(hashtag_mentions(events), size, slide)


def like_windows(events: DataFrame, size: str = VIRAL_WINDOW) -> DataFrame:
    likes = events.where((F.col("event_type") == "LIKE") & F.col("post_id").isNotNull())
    counted = likes.groupBy(F.window("ts", size).alias("w"), "post_id").agg(_rows().alias("like_count"))
    return counted.select(
        "post_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "like_count"
    )


def viral_posts(events: DataFrame, threshold: int = VIRAL_LIKES, size: str = VIRAL_WINDOW) -> DataFrame:
    return like_windows(events, size).where(F.col("like_count") >= threshold)


def engagement(
    events: DataFrame,
    weights: dict[str, float] = ENGAGEMENT_WEIGHTS,
    *,
    owners: DataFrame | None = None,
    size: str | None = None,
) -> DataFrame:
    """Weighted points per user. Event types without a weight are left out.

    Points go to the event's target user; with ``owners`` (post_id, user_id), an event
    without a target gives them to the owner of its post. ``size`` scores per window
    instead of over all time.
    """
    scored = events.where(F.col("event_type").isin(list(weights)))
    receiver = F.col("target_user_id")
    if owners is not None:
        scored = lookup(scored, owners, "post_id", {"user_id": "post_owner"})
        receiver = F.coalesce(receiver, F.col("post_owner"))
    scored = scored.withColumns({
        "__user": receiver, "__points": engagement_points(F.col("event_type"), weights)
    }).where(F.col("__user").isNotNull())
    keys = [F.col("__user").alias("user_id"), *([F.window("ts", size).alias("w")] if size else [])]
    counts = [
        F.sum(flag(F.col("event_type") == kind)).cast("bigint").alias(f"{kind.lower()}_count") for kind in weights
    ]
    summed = scored.groupBy(*keys).agg(F.sum("__points").alias("total_engagement"), *counts)
    if not size:
        return summed
    window = {"window_start": F.col("w.start"), "window_end": F.col("w.end")}
    return summed.withColumns(window).drop("w")


def influencer_ranking(events: DataFrame, **options) -> DataFrame:
    """Users ranked by their points; with ``size``, within each window."""
    within = ["window_start"] if options.get("size") else []
    return rank_by_level(engagement(events, **options), "total_engagement", "rank", within)


def event_breakdown(events: DataFrame) -> DataFrame:
    named = events.withColumn("event_type", F.coalesce("event_type", F.lit("UNKNOWN")))
    return share_by(named, ["event_type"], count_as="events", share_as="percentage", places=1)


def landing_kpis(landed: DataFrame) -> DataFrame:
    """Valid share and latency of landed rows."""
    latency = F.timestamp_diff("SECOND", F.col("event_timestamp"), F.col("ingested_at"))
    return landed.agg(
        _rows().alias("total_events"),
        F.sum(flag(F.col("is_valid"))).cast("bigint").alias("valid_events"),
        percent(F.sum(flag(F.col("is_valid"))), _rows()).alias("valid_pct"),
        tidy(F.avg(latency)).alias("avg_latency_sec"),
        F.max(latency).alias("max_latency_sec"),
    )


def sentiment_share(events: DataFrame) -> DataFrame:
    return share_by(comment_sentiment(events), ["sentiment"], count_as="comments", share_as="percentage")


def top_hashtags(events: DataFrame, last: str = "5 minutes", k: int = 10, as_of: Column | None = None) -> DataFrame:
    """Most mentioned tags of the last ``last`` before ``as_of`` (default: the newest event)."""
    end = scalar(events, F.max("ts")) if as_of is None else as_of
    recent = events.where((F.col("ts") > end - F.expr(f"INTERVAL {last}")) & (F.col("ts") <= end))
    counted = hashtag_mentions(recent).groupBy("hashtag").agg(_rows().alias("mention_count"))
    return top_k(counted, k, "mention_count", ["hashtag"])
