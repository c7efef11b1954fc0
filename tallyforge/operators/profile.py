"""Column profiles from one scan, however many columns are profiled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.bands import first_match
from tallyforge.functions.numbers import percent

from .aggregate import is_numeric


def _typed_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per row and column: the column's number and the value in the slot of its type.

    Numbers and times stay numbers and columns are numbered, which keeps the shuffled rows
    narrow and spares formatting values as text.
    """
    slots = {"whole": "bigint", "real": "double", "other": "string"}
    cells = []
    for number, field in enumerate((df.schema[c] for c in columns), 1):
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.IntegralType):
            used, value = "whole", value.cast("bigint")
        elif isinstance(kind, T.DateType):
            used, value = "whole", F.unix_date(value).cast("bigint")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            used, value = "whole", F.unix_micros(value.cast("timestamp"))
        elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            used, value = "real", value.cast("double")
        else:
            used, value = "other", value.cast("string")
        cells.append(F.lit(number))
        cells += [value if slot == used else F.lit(None).cast(t) for slot, t in slots.items()]
    return df.select(F.stack(F.lit(len(cells) // 4), *cells).alias("column_no", *slots))


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls, distinct values and numeric range per column, from one scan.

    Cells are counted per column and value, so a value that fills a third of the table
    leaves each task as one row. The second aggregation sees one row per distinct value
    and combines them per task again.
    """
    numeric = [n for n, c in enumerate(columns, 1) if is_numeric(df.schema[c].dataType)]
    counted = (
        _typed_cells(df, columns)
        .groupBy("column_no", "whole", "real", "other")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("other").isNotNull()
    number = F.coalesce("real", F.col("whole").cast("double"), F.col("other").try_cast("double"))
    in_range = F.when(F.col("column_no").isin(numeric), number)
    stats = counted.groupBy("column_no").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("null_count"),
        F.sum(F.when(known, 1).otherwise(0)).alias("distinct_count"),
        F.min(in_range).alias("min_value"),
        F.max(in_range).alias("max_value"),
    )
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("column_no"))
    return stats.withColumn("column_name", name).drop("column_no")


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values and nulls per column."""
    return column_stats(df, columns).select(
        "column_name", F.col("distinct_count").alias("distinct_values"), "null_count"
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier row in every column."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    return copies.agg(F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicate_count"))


def quality_report(df: DataFrame) -> DataFrame:
    """Type, nulls, distinct values, duplicates of the whole table, numeric range."""
    types = first_match(
        [(F.col("column_name") == f.name, F.lit(f.dataType.simpleString())) for f in df.schema.fields]
    )
    return column_stats(df, df.columns).select(
        "column_name",
        types.alias("data_type"),
        "null_count",
        percent(F.col("null_count"), F.col("row_count")).alias("null_percentage"),
        "distinct_count",
        duplicate_rows(df).scalar().alias("duplicate_count"),
        "min_value",
        "max_value",
    )


def column_roles(df: DataFrame) -> DataFrame:
    """Identifier, Binary, Numerical or Categorical, tested in that order."""
    numeric = [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    role = first_match(
        [
            (F.col("distinct_count") == F.col("row_count"), F.lit("Identifier")),
            (F.col("distinct_count") == 2, F.lit("Binary")),
            (F.col("column_name").isin(numeric), F.lit("Numerical")),
        ],
        "Categorical",
    )
    return column_stats(df, df.columns).select("column_name", "distinct_count", role.alias("role"))
