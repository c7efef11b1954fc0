"""Tables that are replaced as a whole: a new version is written beside the old one and then published.

A version lies in ``version=<n>``; the marker ``_published/<n>`` appears once all of its rows are written, and readers
take the highest marker. A failed write therefore leaves the old rows, a repeated one publishes nothing twice, and
storage stays at ``keep`` versions however often the table is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import folders


def published(spark: SparkSession, path: str) -> int | None:
    """The newest complete version; None if there is none."""
    found = folders.numbered(spark, f"{path}/_published")
    return found[-1] if found else None


def publish(df: DataFrame, path: str, version: int | None = None, *, keep: int = 2) -> int:
    """Write ``df`` as the next version (or as ``version``, if it is newer than the published one) and publish it.

    ``keep`` versions stay, so that a reader of the version before is not disturbed. ``df`` may read the published version.
    """
    spark = df.sparkSession
    newest = published(spark, path)
    if version is None:
        version = 0 if newest is None else newest + 1
    elif newest is not None and version <= newest:
        return newest  # a retry of what was published before
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/version={version}")
    folders.mark(spark, f"{path}/_published/{version}")
    for old in folders.numbered(spark, f"{path}/_published")[:-keep]:
        folders.drop(spark, f"{path}/_published/{old}")
        folders.drop(spark, f"{path}/version={old}")
    return version


def read(spark: SparkSession, path: str) -> DataFrame:
    newest = published(spark, path)
    if newest is None:
        raise ValueError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/version={newest}")
