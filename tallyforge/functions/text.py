"""Lexicon sentiment on whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bands import first_match

# The sentiment lexicon.
POSITIVE_WORDS = [
    "love", "great", "awesome", "amazing", "good",
    "excellent", "fantastic", "wonderful", "best", "happy",
]
NEGATIVE_WORDS = [
    "hate", "bad", "terrible", "awful", "worst",
    "poor", "horrible", "disappointing", "sad", "angry",
]


# Any run of Unicode white space, and the four ASCII separators next to it.
WORD_BREAK = r"(?U)[\s\x1c-\x1f]+"


def distinct_hits(text: Column, lexicon: list[str]) -> Column:
    """How many lexicon words occur in the text. Punctuation stays on its word."""
    words = F.split(F.lower(text), WORD_BREAK)
    return F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in lexicon])))


def sentiment(text: Column) -> Column:
    """positive / negative by majority of distinct hits; ties and missing texts are neutral."""
    safe = F.coalesce(text, F.lit(""))
    positive = distinct_hits(safe, POSITIVE_WORDS)
    negative = distinct_hits(safe, NEGATIVE_WORDS)
    return first_match(
        [(positive > negative, F.lit("positive")), (negative > positive, F.lit("negative"))],
        "neutral",
    )
