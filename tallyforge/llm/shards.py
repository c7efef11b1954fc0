"""Contiguous shards of near-equal bytes, from prefix sums over per-partition totals.

Rows are range-partitioned by id. Each partition numbers and sums its own rows; the totals of the partitions, one
row each, give every partition its start; a row's shard follows from the bytes before it. No task sees more than
its range, and only the totals (as many rows as partitions) are put in one order.

Edge cases: a null text has no bytes (size 1, checksum 0), rows with equal or missing ids are ordered by checksum,
size and arrival and may fall on both sides of a cut, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import text_of, utf8, written

SHARDS = 16


def sized(docs: DataFrame) -> DataFrame:
    body = text_of()
    return docs.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(utf8(body)).alias("text_crc32"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """Rows with their partition in the order of ids and their place in it, written once so that neither can move."""
    tie = F.monotonically_increasing_id()  # splits rows that are alike in everything else
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size"), F.col("tie")]
    ranged = rows.withColumn("tie", tie).repartitionByRange(*order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return written(ranged.withColumns({"part": F.spark_partition_id(), "place": within}).drop("tie"), "shards")


def prefix_sums(rows: DataFrame) -> DataFrame:
    """``placed`` rows with ``before`` (bytes of all rows ahead), ``row`` (rows ahead) and ``total`` (all bytes)."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("part").agg(F.sum("size").alias("n_bytes"), F.count(F.lit(1)).alias("n_rows")).select(
        "part",
        F.coalesce(F.sum("n_bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("n_bytes").over(Window.partitionBy()).alias("total"),
    )
    own = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # parts stay whole and evenly spread: ranges of part numbers, not their hashes
    inside = rows.repartitionByRange("part").withColumn("own", F.coalesce(F.sum("size").over(own), F.lit(0)))
    # one row per partition: bounded by the number of shuffle partitions, whatever the data
    return inside.join(F.broadcast(starts), "part").select(
        "doc_id", "size", "text_crc32", "total",
        (F.col("bytes_before") + F.col("own")).alias("before"),
        (F.col("rows_before") + F.col("place")).alias("row"),
    )


def cut(n: int) -> Column:
    """The shard in which a row's middle byte lies, of ``n`` equal stretches of all bytes."""
    return F.least(F.expr(f"((2 * before + size) * {n}L) div (2 * total)"), F.lit(n - 1)).cast("int")


def shard(docs: DataFrame, n: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard 0 to ``n - 1`` and the row's gapless slot in it.

    A shard's bytes differ from total / n by less than the largest row.
    """
    rows = prefix_sums(placed(sized(docs))).withColumn("shard", cut(n))
    first = rows.groupBy("shard").agg(F.min("row").alias("first_row"))
    return rows.join(F.broadcast(first), "shard").select(  # n rows
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot")
    )
