"""JSON messages: decoding, keyed encoding, flattening, merging into arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators.ordered import number_rows, place_in_blocks


# Times in messages keep their microseconds.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Columns of a message beside its value, and their names after decoding.
ARRIVAL = {
    "key": "message_key", "partition": "message_partition", "offset": "message_offset", "timestamp": "message_time",
}


def decode_events(messages: DataFrame, schema: T.StructType, *, time_column: str | None = None) -> DataFrame:
    """Fields of a JSON ``value``, beside the original text as ``raw_payload``.

    ``time_column`` names a text field to parse into the event time ``ts`` (NULL if it is no
    timestamp). Malformed JSON gives a row of NULLs, so it can be counted and routed. What the
    broker knows of a message stays with it under the names of ``ARRIVAL``, where it is present.
    """
    text = F.col("value").cast("string")
    known = [F.col(c).alias(name) for c, name in ARRIVAL.items() if c in messages.columns]
    rows = messages.select(text.alias("raw_payload"), F.from_json(text, schema).alias("d"), *known)
    rows = rows.select("d.*", "raw_payload", *[name for c, name in ARRIVAL.items() if c in messages.columns])
    return rows.withColumn("ts", F.col(time_column).try_cast("timestamp")) if time_column else rows


def to_keyed_messages(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(key, value) text pairs ready for a message sink; the value is the row as JSON."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*(columns or df.columns)), TIME_FORMATS).alias("value")
    )


def send_to_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Write keyed messages to Kafka; every in-sync replica must acknowledge."""
    (
        messages.write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "5"})
        .save()
    )


def flatten_users(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Nested user records (JSON text) as flat rows."""
    user = df.select(F.from_json(F.col(column).cast("string"), schema).alias("u"))
    return user.select(
        "u.id", "u.name", "u.email", F.col("u.address.city").alias("city"), F.col("u.company.name").alias("company")
    )


def parse_tags(text: Column) -> Column:
    """JSON array of strings; anything else is NULL."""
    return F.from_json(text, "array<string>")


def merge_records(
    df: DataFrame, order: str, *, size: int = 1000, blocks: int | None = None
) -> DataFrame:
    """Records merged into JSON arrays of at most ``size``, in the order of a unique column.

    A stream bounds the age of a batch by its trigger; here the count closes a batch. The
    position of a record is found without sorting the table in one task.
    """
    by = [F.asc_nulls_last(order)]
    numbered = number_rows(place_in_blocks(df, by, blocks), [], by, number_as="__n")
    batch = F.floor((F.col("__n") - 1) / size).cast("bigint")
    packed = F.struct("__n", F.to_json(F.struct(*df.columns), TIME_FORMATS).alias("__json"))
    merged = numbered.groupBy(batch.alias("batch_no")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min(order).alias("first_record"),
        F.max(order).alias("last_record"),
        F.array_sort(F.collect_list(packed)).alias("__records"),
    )
    array = F.concat(F.lit("["), F.array_join(F.col("__records.__json"), ","), F.lit("]"))
    return merged.withColumn("records", array).drop("__records")
