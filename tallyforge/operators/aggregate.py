"""Grouped measures: rates, shares, top rows, modes, stacked dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyforge.functions.numbers import percent
from tallyforge.session import ensure_checkpoints


def rate_by(
    df: DataFrame,
    keys: Sequence[str],
    flag: str,
    *,
    count_as: str,
    hits_as: str | None,
    rate_as: str,
    places: int | None = 2,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Rows, flagged rows and flagged percentage per group, in one aggregation.

    ``flag`` is a 0/1 column. ``hits_as=None`` leaves the flagged count out.
    """
    hits = F.sum(F.col(flag)).cast("bigint")
    measures = [F.count(F.lit(1)).alias(count_as)]
    if hits_as:
        measures.append(hits.alias(hits_as))
    measures.append(percent(hits, F.count(F.lit(1)), places).alias(rate_as))
    return df.groupBy(*keys).agg(*measures, *extra)


def share_by(
    df: DataFrame, keys: Sequence[str], *, within: Sequence[str] = (), count_as: str, share_as: str,
    places: int = 2,
) -> DataFrame:
    """Rows per group and their percentage of all rows (or of the rows ``within``).

    The total is summed over the grouped rows, so only one row per group crosses
    the window.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as))
    whole = F.sum(count_as).over(Window.partitionBy(*within))
    return counted.withColumn(share_as, percent(F.col(count_as), whole, places))


def stack_dimensions(
    df: DataFrame, dimensions: Sequence[str], keep: Sequence[str], *,
    name_as: str = "dimension", value_as: str = "value",
) -> DataFrame:
    """One row per input row and dimension, so one scan serves all dimensions."""
    texts = [F.col(d).cast("string").alias(d) for d in dimensions]
    held = [F.col(k).alias(f"__{k}") for k in keep]
    long = df.select(*held, *texts).unpivot([f"__{k}" for k in keep], list(dimensions), name_as, value_as)
    return long.select(name_as, value_as, *[F.col(f"__{k}").alias(k) for k in keep])


def top_k(df: DataFrame, k: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The k rows with the largest ``by``; ``ties`` decide between equals."""
    order = [F.desc_nulls_last(by), *[F.asc_nulls_last(c) for c in ties]]
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, k: int, group: Sequence[str], by: str, ties: Sequence[str],
                    position_as: str) -> DataFrame:
    """First k rows of each group. Each task keeps only its own k before the shuffle."""
    order = [F.desc_nulls_last(by), *[F.asc_nulls_last(c) for c in ties]]
    position = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(position_as, position).where(F.col(position_as) <= k)


def top_rank_per_group(df: DataFrame, k: int, group: Sequence[str], by: str, rank_as: str) -> DataFrame:
    """Rows ranked k or better in their group; equal values share a rank."""
    order = Window.partitionBy(*group).orderBy(F.desc_nulls_last(by))
    return df.withColumn(rank_as, F.rank().over(order)).where(F.col(rank_as) <= k)


def most_common(df: DataFrame, column: str) -> Column:
    """Most frequent non-null value as a scalar subquery; the smallest value wins a tie."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return top_k(counted, 1, "n", [column]).select(column).scalar()


def scalar(df: DataFrame, value: Column) -> Column:
    """A one-row aggregate usable inside any expression, without a join."""
    return df.agg(value.alias("value")).scalar()


def rank_by_level(df: DataFrame, level: str, rank_as: str, within: Sequence[str] = ()) -> DataFrame:
    """Rank all rows (of each ``within``) by a counter, largest first, without sorting the rows.

    Rows are counted per level, the few levels are ranked, and each row looks its
    level up. Distinct levels of a counter grow with the square root of what was
    counted, so the window over them stays small where rows would not.
    The rows are read twice, so they are checkpointed rather than computed twice.
    """
    ensure_checkpoints(df.sparkSession)
    df = df.checkpoint()
    keys = [*within, level]
    levels = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    above = Window.partitionBy(*within).orderBy(F.desc_nulls_last(level)).rowsBetween(Window.unboundedPreceding, -1)
    ranked = levels.select(
        *[F.col(k).alias(f"__on_{k}") for k in keys],
        (F.coalesce(F.sum("__rows").over(above), F.lit(0)) + 1).alias(rank_as),
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__on_{k}")) for k in keys])
    return df.join(ranked, same, "left").drop(*[f"__on_{k}" for k in keys])


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)
