"""Rules for social events: validation messages and engagement weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bands import first_match

# Accepted event types, and those that must name a post.
EVENT_TYPES = ["POST_CREATED", "LIKE", "COMMENT", "SHARE", "FOLLOW", "VIDEO_VIEW", "PROFILE_VISIT"]
POST_EVENT_TYPES = ["LIKE", "COMMENT", "SHARE", "VIDEO_VIEW"]

# Points an event gives to the user it targets.
ENGAGEMENT_WEIGHTS = {"LIKE": 1, "COMMENT": 3, "SHARE": 5, "FOLLOW": 10}


def is_missing(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def validation_errors() -> Column:
    """All broken rules joined by ``; ``; the empty string for a valid event."""
    kind = F.col("event_type")
    unknown_type = ~F.coalesce(kind.isin(EVENT_TYPES), F.lit(False))
    needs_post = F.coalesce(kind.isin(POST_EVENT_TYPES), F.lit(False))
    return F.concat_ws(
        "; ",
        F.when(is_missing(F.col("event_id")), F.lit("missing event_id")),
        F.when(unknown_type, F.concat(F.lit("invalid event_type: "), F.coalesce(kind, F.lit("None")))),
        F.when(is_missing(F.col("user_id")), F.lit("missing user_id")),
        F.when(
            needs_post & is_missing(F.col("post_id")),
            F.lit("missing post_id for event type that requires it"),
        ),
    )


def engagement_points(kind: Column, weights: dict[str, float] = ENGAGEMENT_WEIGHTS) -> Column:
    return first_match([(kind == name, F.lit(points)) for name, points in weights.items()], 0)
