"""Sinks. Every write runs on the executors; a repeated write replaces itself."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import folders, versions


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Replace the table at ``path``, one folder per value of ``by``."""
    df.write.mode("overwrite").partitionBy(*by).option("partitionOverwriteMode", "static").parquet(path)


def refresh_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace only the folders of ``by`` that occur in ``df``."""
    df.write.mode("overwrite").partitionBy(*by).option("partitionOverwriteMode", "dynamic").parquet(path)


def reload_table(df: DataFrame, path: str) -> None:
    """Replace the rows of the table at ``path``: read it with ``versions.read``. A failed reload leaves the old rows."""
    versions.publish(df, path)


def append_checked(spark: SparkSession, df: DataFrame, path: str, batch_id: int) -> bool:
    """Create the table if it is missing, else append; False if the batch was appended before.

    The columns must be the table's, whose schema lies beside the rows in ``_schema``; batches that are whole are listed in
    ``_commits``. Rows lie under ``batch_id=<n>``, so a batch that failed half-way replaces what it wrote.
    """
    known = folders.text_of(spark, f"{path}/_schema")
    if known is None:
        folders.mark(spark, f"{path}/_schema", df.schema.json())
    elif {(f.name, f.dataType) for f in StructType.fromJson(json.loads(known))} != {(f.name, f.dataType) for f in df.schema}:
        raise ValueError(f"columns differ from the table at {path}")
    if folders.exists(spark, f"{path}/_commits/{batch_id}"):
        return False
    write_batch(df, path, batch_id)
    folders.mark(spark, f"{path}/_commits/{batch_id}")
    return True


def write_batch(df: DataFrame, path: str, batch_id: int, *by: str, format: str = "parquet") -> None:
    """The rows of one micro-batch under ``batch_id=<n>``; a retried batch replaces its folder."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).format(format).save(f"{path}/batch_id={batch_id}")


def write_dead_letters(validated: DataFrame, path: str, batch_id: int = 0) -> None:
    """Invalid events with their errors, as JSON."""
    write_batch(validated.where("NOT is_valid"), path, batch_id, format="json")


def route_by_class(df: DataFrame, path: str, column: str) -> None:
    """One table per class; the class is the folder name and leaves the rows."""
    write_partitioned(df, path, column)


def read_class(spark: SparkSession, path: str, column: str, value: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col(column) == value).drop(column)
