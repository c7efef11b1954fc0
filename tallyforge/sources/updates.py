"""Upserts as a log of emitted rows.

A streaming aggregate emits a key again whenever it changes. Instead of rewriting a table
for every micro-batch, the emitted rows are appended under their batch number. The current
table and the correction history are views over that log, and a retried batch replaces its
own folder, so nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .writers import write_batch


def log_updates(
    path: str, shape: Callable[[DataFrame], DataFrame] | None = None, *, stamped_as: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that logs each batch at ``path``.

    ``shape`` is applied to the batch first; ``stamped_as`` names a column for the time of writing.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        if stamped_as:
            rows = rows.withColumn(stamped_as, F.current_timestamp())
        write_batch(rows, path, batch_id)

    return sink


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def history(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every version of every key. Version 1 is the first write, later ones are corrections."""
    by_batch = Window.partitionBy(*keys).orderBy("batch_id")
    return log.withColumn("version", F.row_number().over(by_batch)).withColumn(
        "is_correction", F.col("version") > 1
    )


def current(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key with its version: what an upsert by key would hold."""
    values = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*values), "batch_id").alias("row")
    return log.groupBy(*keys).agg(newest, F.count(F.lit(1)).cast("int").alias("version")).select(
        *keys, *[F.col(f"row.{c}").alias(c) for c in values], "version"
    )


def latest_batch(log: DataFrame) -> DataFrame:
    """Rows of the newest batch only: what a table replaced on every batch would hold."""
    newest = log.agg(F.max("batch_id").alias("b")).scalar()
    return log.where(F.col("batch_id") == newest)


def compact(spark: SparkSession, path: str, into: str, keys: Sequence[str]) -> None:
    """Fold a log into a new table of current rows."""
    current(read_log(spark, path), keys).write.mode("overwrite").parquet(into)
