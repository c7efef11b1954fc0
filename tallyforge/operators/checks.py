"""Data tests and gates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_table_tests(name: str, df: DataFrame, unique: str | None, not_null: Sequence[str]) -> DataFrame:
    """Failures of the declared tests of one table, from one pass over it.

    A key failing ``unique`` counts once, however often it occurs; nulls do not fail it.
    """
    nulls = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"null_{c}") for c in not_null]
    if unique:
        grouped = df.groupBy(unique).agg(F.count(F.lit(1)).alias("__n"), *nulls)
        repeated = F.when(F.col(unique).isNotNull() & (F.col("__n") > 1), 1).otherwise(0)
        failures = grouped.agg(
            F.sum(repeated).cast("bigint").alias("repeats"),
            *[F.sum(f"null_{c}").cast("bigint").alias(f"null_{c}") for c in not_null],
        )
    else:
        failures = df.agg(*nulls)
    tests = [(unique, "unique", "repeats")] if unique else []
    tests += [(c, "not_null", f"null_{c}") for c in not_null]
    rows = F.array(*[
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(kind).alias("test"),
            F.coalesce(F.col(source), F.lit(0)).cast("bigint").alias("failures"),
        )
        for column, kind, source in tests
    ])
    return failures.select(F.lit(name).alias("model"), F.inline(rows))


def source_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Row count per named source."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("source"), "row_count")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("is_empty", F.col("row_count") == 0)


def require_rows(**sources: DataFrame) -> None:
    """Stop the job when a source is empty. Reads at most one row of each."""
    empty = sorted(name for name, df in sources.items() if df.isEmpty())
    if empty:
        raise ValueError(f"no rows in: {', '.join(empty)}")
