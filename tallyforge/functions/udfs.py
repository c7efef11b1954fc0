"""The rules by name, for SQL users.

``register`` makes SQL functions of them, which Spark inlines into the query like any other expression.
``classify_sentiment_udf`` is the sample of an Arrow-batched function, for rules that have no expression.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import NEGATIVE_WORDS, POSITIVE_WORDS, WORD_BREAK

_POSITIVE, _NEGATIVE = frozenset(POSITIVE_WORDS), frozenset(NEGATIVE_WORDS)


@F.pandas_udf(T.StringType())
def classify_sentiment_udf(text: pd.Series) -> pd.Series:
    labels = []
    for words in text.fillna("").str.lower().str.split():
        balance = len(_POSITIVE.intersection(words)) - len(_NEGATIVE.intersection(words))
        labels.append("positive" if balance > 0 else "negative" if balance < 0 else "neutral")
    return pd.Series(labels)


def _array(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{word}'" for word in words) + ")"


# The bounds of the risk classes.
RISK = """CASE WHEN amount > 10000 OR credit_score < 500 OR failed_attempts > 3 THEN 'high'
  WHEN amount > 5000 OR credit_score < 650 THEN 'medium' ELSE 'low' END"""

_BREAK = WORD_BREAK.replace("\\", "\\\\")  # as a SQL literal
_SPOKEN = f"split(lower(coalesce(text, '')), '{_BREAK}')"
SENTIMENT = f"""CASE sign(size(array_intersect({_SPOKEN}, {_array(POSITIVE_WORDS)}))
    - size(array_intersect({_SPOKEN}, {_array(NEGATIVE_WORDS)})))
  WHEN 1 THEN 'positive' WHEN -1 THEN 'negative' ELSE 'neutral' END"""


def register(spark: SparkSession) -> None:
    """Make the rules callable from SQL text of this session."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION classify_risk(
        amount DOUBLE, credit_score INT, failed_attempts INT) RETURNS STRING RETURN {RISK}""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION classify_sentiment(text STRING)
        RETURNS STRING RETURN {SENTIMENT}""")
