"""Batch and streaming scans with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean "no value" in delivered CSV files.
NULL_MARKERS = ["", "NULL", "null"]


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, null_markers: Sequence[str] = NULL_MARKERS,
    multi_line: bool = False,
) -> DataFrame:
    """Typed rows of a headed CSV file; rows that do not fit the schema are left to ``csv_rejects``.

    A row fits when it has the right number of fields and every field casts to its type.
    Fields are read as text and cast here, and all of them are parsed, so what counts as a
    bad row does not depend on which columns a later query selects. A field may be enclosed in
    quotes, a quote in it is doubled, and a backslash is a character like any other. Line breaks
    inside quotes need ``multi_line``, with which a file is no longer split among tasks.
    """
    values, fits = _parsed_csv(spark, path, schema, null_markers, multi_line)
    return values.where(fits).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def csv_rejects(
    spark: SparkSession, path: str, schema: T.StructType, *, null_markers: Sequence[str] = NULL_MARKERS,
    multi_line: bool = False,
) -> DataFrame:
    """The rows that ``read_csv`` leaves out: their text where the line is malformed, and all fields as text."""
    values, fits = _parsed_csv(spark, path, schema, null_markers, multi_line)
    return values.where(~fits).withColumnRenamed("__bad", "malformed")


def _parsed_csv(
    spark: SparkSession, path: str, schema: T.StructType, null_markers: Sequence[str], multi_line: bool
) -> tuple[DataFrame, Column]:
    """All fields as text, and whether a row fits ``schema``."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(texts.add("__bad", "string"))
        .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="__bad", columnPruning=False,
                 quote='"', escape='"', multiLine=multi_line)
        .csv(path)
    )
    values = raw.select(
        "__bad",
        *[F.when(~F.col(f.name).isin(list(null_markers)), F.col(f.name)).alias(f.name) for f in schema.fields],
    )
    fits = [
        F.col(f.name).isNull() | F.col(f.name).try_cast(f.dataType).isNotNull()
        for f in schema.fields if not isinstance(f.dataType, T.StringType)
    ]
    return values, reduce(and_, fits, F.col("__bad").isNull())


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def stream_json_dir(
    spark: SparkSession, path: str, schema: T.StructType, *, files_per_trigger: int | None = None
) -> DataFrame:
    """Files dropped into a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def stream_topic(
    spark: SparkSession, servers: str, topic: str, *, starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """A Kafka topic (needs the connector on the class path). Yields ``key``, ``value``, ``partition``, ``offset``, ``timestamp``."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()
