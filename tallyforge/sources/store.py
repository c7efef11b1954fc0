"""Upserts by key as a store of two levels: a snapshot of newest rows, and a short tail of batches after it.

A batch is appended to the tail. Every ``fold_every`` batches the tail is folded: the snapshot gets a new version with each key's newest
row and how often the key was written, and the folded rows go to the archive with their final version numbers. Readers join one
snapshot with at most ``fold_every`` batches, whatever the age of the store; nothing is sorted for that, and folded
batches are dropped one fold later, so a reader that still uses the snapshot before is not disturbed.

A batch holds a key once at most, as the update mode of a streaming aggregate guarantees. A retried batch replaces its folder or, once folded,
is left as it is. Null keys are equal to each other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import folders, versions
from .writers import write_batch


class UpsertStore:
    def __init__(self, path: str, keys: Sequence[str], *, fold_every: int = 10):
        self.path, self.keys, self.fold_every = path, list(keys), fold_every

    def sink(self, shape: Callable[[DataFrame], DataFrame] | None = None, *, stamped_as: str | None = None):
        """A ``foreachBatch`` function that upserts each batch; ``stamped_as`` names a column for the time of writing."""

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = shape(batch) if shape else batch
            self.write(rows.withColumn(stamped_as, F.current_timestamp()) if stamped_as else rows, batch_id)

        return write

    def write(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        base = self._base(spark)
        if batch_id <= base:
            return  # folded already
        write_batch(rows, f"{self.path}/tail", batch_id)
        if batch_id - base >= self.fold_every:
            self.fold(spark, batch_id)

    def current(self, spark: SparkSession) -> DataFrame:
        """The newest row of every key, with ``batch_id`` and ``version``, the number of times it was written."""
        base = self._base(spark)
        tail = self._tail(spark, base)
        if base < 0:
            return self._newest(tail)
        snapshot = versions.read(spark, f"{self.path}/snapshot")
        return snapshot if tail is None else self._merged(snapshot, tail)

    def history(self, spark: SparkSession) -> DataFrame:
        """Every row ever written, with its ``version`` within the key and ``is_correction``, true from the second on."""
        base = self._base(spark)
        tail = self._tail(spark, base)
        parts = [self._versions(spark, tail, base)] if tail is not None else []
        folded = folders.numbered(spark, f"{self.path}/archive", "upto=")
        paths = [f"{self.path}/archive/upto={upto}" for upto in folded if upto <= base]
        parts += [spark.read.parquet(*paths)] if paths else []
        if not parts:
            raise ValueError(f"nothing is written at {self.path}")
        return reduce(DataFrame.unionByName, parts).withColumn("is_correction", F.col("version") > 1)

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Bring the snapshot up to the batch ``upto``."""
        base = self._base(spark)
        tail = self._tail(spark, base, upto)
        if tail is None:
            return
        self._versions(spark, tail, base).write.mode("overwrite").parquet(f"{self.path}/archive/upto={upto}")
        merged = self._newest(tail) if base < 0 else self._merged(versions.read(spark, f"{self.path}/snapshot"), tail)
        versions.publish(merged, f"{self.path}/snapshot", upto)
        for old in folders.numbered(spark, f"{self.path}/tail", "batch_id="):
            if old <= base:
                folders.drop(spark, f"{self.path}/tail/batch_id={old}")

    def _base(self, spark: SparkSession) -> int:
        """The last batch in the snapshot, -1 without one."""
        newest = versions.published(spark, f"{self.path}/snapshot")
        return -1 if newest is None else newest

    def _tail(self, spark: SparkSession, base: int, upto: int | None = None) -> DataFrame | None:
        found = [n for n in folders.numbered(spark, f"{self.path}/tail", "batch_id=") if n > base and (upto is None or n <= upto)]
        if not found:
            if base < 0:
                raise ValueError(f"nothing is written at {self.path}")
            return None
        reader = spark.read.option("basePath", f"{self.path}/tail")
        rows = reader.parquet(*[f"{self.path}/tail/batch_id={n}" for n in found])
        return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))

    def _same(self, left: str, right: str) -> Column:
        return reduce(and_, [F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}")) for key in self.keys])

    def _newest(self, tail: DataFrame) -> DataFrame:
        """The last row of each key of the tail; counts and the last batch are hash aggregates of two numbers."""
        last = tail.groupBy(*self.keys).agg(F.max("batch_id").alias("__last"), F.count(F.lit(1)).alias("version"))
        met = tail.alias("t").join(last.hint("shuffle_hash").alias("l"), self._same("t", "l") & (F.col("t.batch_id") == F.col("l.__last")))
        return met.select("t.*", "l.version")

    def _merged(self, snapshot: DataFrame, tail: DataFrame) -> DataFrame:
        new = self._newest(tail).hint("shuffle_hash").alias("n")  # the tail is the side that is bounded
        met = snapshot.alias("s").join(new, self._same("s", "n"), "full")
        fresh = F.col("n.version").isNotNull()
        columns = [F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in snapshot.columns if c != "version"]
        zero = F.lit(0).cast("bigint")
        return met.select(*columns, (F.coalesce("s.version", zero) + F.coalesce("n.version", zero)).alias("version"))

    def _versions(self, spark: SparkSession, tail: DataFrame, base: int) -> DataFrame:
        """The tail's rows numbered on from the snapshot; a key has at most as many as the tail has batches."""
        inside = F.row_number().over(Window.partitionBy(*self.keys).orderBy("batch_id")).cast("bigint")
        rows = tail.withColumn("version", inside)
        if base < 0:
            return rows
        before = versions.read(spark, f"{self.path}/snapshot").select(*self.keys, F.col("version").alias("__before"))
        met = rows.alias("t").hint("shuffle_hash").join(before.alias("b"), self._same("t", "b"), "left")
        counted = (F.col("t.version") + F.coalesce("b.__before", F.lit(0))).alias("version")
        return met.select(*[F.col(f"t.{c}") for c in tail.columns], counted)
