"""Ranks, row numbers and running sums over orders too large for one task.

A window without a partition, or with one key that holds a third of all rows,
would sort those rows in a single task. Here the rows are range-partitioned by
the full order into blocks and sorted there, each block is numbered on its own
from the places of its rows, and every block starts from the totals of the
blocks before it. So full rows are shuffled once, and no window follows. Block
boundaries come from sampling, so the placed rows are checkpointed: every later
read, also one after a lost executor, sees the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyforge.session import ensure_checkpoints

BLOCK = "__block"
PLACE = "__place"
#: Bits that a partition's own numbers have in ``monotonically_increasing_id``.
PLACE_BITS = 33


def asc(name: str) -> Column:
    return F.asc_nulls_last(name)


def desc(name: str) -> Column:
    return F.desc_nulls_last(name)


def place_in_blocks(df: DataFrame, order: Sequence[Column], blocks: int | None = None) -> DataFrame:
    """Rows with the number of their contiguous range of ``order``, and their place in it from 0.

    Without ``blocks`` the reducer count follows the data size (AQE merges small
    ranges). Pass only the columns that are needed: the result is written out, in order.
    """
    ensure_checkpoints(df.sparkSession)
    ranged = df.repartitionByRange(blocks, *order) if blocks else df.repartitionByRange(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return ranged.sortWithinPartitions(*order).withColumns({BLOCK: F.spark_partition_id(), PLACE: place}).checkpoint()


def _attach(left: DataFrame, right: DataFrame, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left join on null-safe keys."""
    slim = right.select(*[F.col(n).alias(f"__on_{n}") for n in on], *values)
    same = reduce(and_, [left[n].eqNullSafe(slim[f"__on_{n}"]) for n in on])
    return left.join(slim, same, "left").drop(*[f"__on_{n}" for n in on])


def _attach_carried(rows: DataFrame, carried: DataFrame, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Add what a key brings along from earlier blocks.

    Ranges are contiguous, so at most one key crosses each boundary between two blocks:
    ``carried`` has fewer rows than there are blocks, which bounds the broadcast.
    """
    return _attach(rows, F.broadcast(carried), on, values)


def _walked(
    placed: DataFrame,
    keys: Sequence[str],
    *,
    number_as: str,
    sums: dict[str, str] | None = None,
    rank_by: str | None = None,
    rank_as: str | None = None,
) -> DataFrame:
    """``placed`` with numbers, running sums and ranks within (block, ``keys``), in one walk over each block as it lies.

    Nothing is shuffled or sorted; what a task holds is an Arrow batch and the last row's state. A running sum passes over
    nulls and is null until the first value. Summed columns are integers or floating point numbers.
    """
    on, sums = [BLOCK, *keys], sums or {}
    types = dict(placed.dtypes)
    whole = {name: types[source] in ("tinyint", "smallint", "int", "bigint") for name, source in sums.items()}
    for name, source in sums.items():
        if not whole[name] and types[source] not in ("float", "double"):
            raise TypeError(f"running sum of {source}: {types[source]} is neither an integer nor a floating point number")

    # helpers live in here, so that workers need no copy of this module
    def differs(column: pa.Array, last: pa.Array | None) -> np.ndarray:
        """Whether a value is another than the one above it, for nulls and NaN as a grouping sees them."""
        above = pa.concat_arrays([column.slice(0, 1) if last is None else last, column.slice(0, len(column) - 1)])
        other = pc.not_equal(column, above)
        if pa.types.is_floating(column.type):
            other = pc.and_(other, pc.invert(pc.and_(pc.is_nan(column), pc.is_nan(above))))
        one_is_null = pc.xor(pc.is_null(column), pc.is_null(above))
        out = pc.or_(pc.fill_null(other, False), one_is_null).to_numpy(zero_copy_only=False)
        if last is None:
            out[:1] = True
        return out

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, pa.Array] = {}
        count, rank, total, met = 0, 0, dict.fromkeys(sums, 0), dict.fromkeys(sums, False)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = {name: batch.column(name) for name in {*on, *([rank_by] if rank_by else [])}}
            new = reduce(np.logical_or, [differs(columns[name], last.get(name)) for name in on])
            at = np.arange(n)
            begin = np.maximum.accumulate(np.where(new, at, -1))  # -1: the key went on from the batch before
            number = np.where(begin < 0, at + 1 + count, at - begin + 1)
            added = [pa.array(number, pa.int64())]
            group = np.cumsum(new)
            for name, source in sums.items():
                column = batch.column(batch.schema.get_field_index(source))
                values = pc.fill_null(column.cast(pa.int64() if whole[name] else pa.float64()), 0).to_numpy(zero_copy_only=False)
                valid = pc.is_valid(column).to_numpy(zero_copy_only=False)
                run = pd.Series(values).groupby(group).cumsum().to_numpy()
                seen = pd.Series(valid).groupby(group).cummax().to_numpy(bool)
                run = np.where(begin < 0, run + total[name], run)
                seen = np.where(begin < 0, seen | met[name], seen)
                total[name], met[name] = run[-1], bool(seen[-1])
                added.append(pa.array(run, mask=~seen))
            if rank_by:
                level = np.maximum.accumulate(np.where(new | differs(columns[rank_by], last.get(rank_by)), at, -1))
                ranks = np.where(level < 0, rank, number[level])
                rank = int(ranks[-1])
                added.append(pa.array(ranks, pa.int64()))
            count = int(number[-1])
            last = {name: column.slice(n - 1, 1) for name, column in columns.items()}
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    names = [number_as, *sums, *([rank_as] if rank_by else [])]
    kinds = [T.LongType(), *[T.LongType() if whole[name] else T.DoubleType() for name in sums], *([T.LongType()] if rank_by else [])]
    added = [T.StructField(name, kind) for name, kind in zip(names, kinds)]
    return placed.mapInArrow(walk, T.StructType([*placed.schema.fields, *added]))


def _at_edges(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of keys that begin or end a block: only these go on from one block to another."""
    if not keys:
        return placed
    edge = F.struct(*[F.col(name).alias(f"__k{at}") for at, name in enumerate(keys)])
    ends = placed.groupBy(BLOCK).agg(F.min_by(edge, PLACE).alias("__head"), F.max_by(edge, PLACE).alias("__tail"))
    slim = F.broadcast(ends.withColumnRenamed(BLOCK, "__of"))  # one row per block
    met = placed.join(slim, placed[BLOCK] == slim["__of"])
    return met.where((edge == F.col("__head")) | (edge == F.col("__tail"))).drop("__of", "__head", "__tail")


def number_rows(
    placed: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    number_as: str,
    sums: dict[str, str] | None = None,
) -> DataFrame:
    """Row number, and running sums (``{new column: summed column}``), within ``keys``.

    ``placed`` must come from ``place_in_blocks`` by ``keys`` then ``order``, and ``order``
    must be unique within a key.
    """
    sums = sums or {}
    on = [BLOCK, *keys]
    if keys or sums:
        inside = _walked(placed, keys, number_as=number_as, sums=sums)
    else:
        inside = placed.withColumn(number_as, F.col(PLACE) + 1)

    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    totals = _at_edges(placed, keys).groupBy(*on).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(s).alias(f"__s_{name}") for name, s in sums.items()]
    )
    carried = totals.select(
        *on,
        F.sum("__n").over(before).alias("__n0"),
        *[F.sum(f"__s_{name}").over(before).alias(f"__s0_{name}") for name in sums],
    ).where(F.col("__n0").isNotNull())  # only keys that began in an earlier block

    carries = ["__n0", *[f"__s0_{name}" for name in sums]]
    joined = _attach_carried(inside, carried, on, carries)
    zero = F.lit(0)

    def with_carry(name: str) -> Column:
        carry = F.col(f"__s0_{name}")
        return F.coalesce(F.col(name) + F.coalesce(carry, zero), carry)

    return joined.withColumns(
        {number_as: F.col(number_as) + F.coalesce("__n0", zero), **{name: with_carry(name) for name in sums}}
    ).drop(*carries, BLOCK, PLACE)


def rank_rows(placed: DataFrame, keys: Sequence[str], by: str, *, rank_as: str) -> DataFrame:
    """``RANK`` by ``by`` descending within ``keys``.

    ``placed`` must come from ``place_in_blocks`` by ``keys``, ``by`` descending and a unique
    column, so a group of equal values may span blocks; it keeps the rank of its first row.
    """
    on = [BLOCK, *keys]
    inside = _walked(placed, keys, number_as="__at", rank_by=by, rank_as="__r").drop("__at")
    slim = _at_edges(placed, keys).select(*on, PLACE, by)
    summary = slim.groupBy(*on).agg(
        F.count(F.lit(1)).alias("__n"), F.min_by(by, PLACE).alias("__first"), F.max_by(by, PLACE).alias("__last"),
        F.min(PLACE).alias("__begin"),
    )
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("__n0", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    # where the value that a block ends with begins in it: one more pass, over the rows of that value alone
    final = F.broadcast(summary.select(*[F.col(n).alias(f"__on_{n}") for n in on], F.col("__last").alias("__on_by")))
    same = reduce(and_, [slim[n].eqNullSafe(final[f"__on_{n}"]) for n in on]) & slim[by].eqNullSafe(final["__on_by"])
    begins = slim.join(final, same, "left_semi").groupBy(*on).agg(F.min(PLACE).alias("__level"))
    summary = _attach(summary, begins, on, ["__level"]).withColumn("__last_r", F.col("__level") - F.col("__begin") + 1)
    # rank of the value a block ends with: the smallest over the blocks that end with it
    ends = summary.groupBy(*keys, "__last").agg(F.min(F.col("__n0") + F.col("__last_r")).alias("__end_rank"))
    ends = ends.withColumnRenamed("__last", "__first")
    carried = _attach(summary.where("__n0 > 0").drop("__last"), ends, [*keys, "__first"], ["__end_rank"])
    carried = carried.withColumn("__start", F.least(F.col("__n0") + 1, F.col("__end_rank")))

    joined = _attach_carried(inside, carried, on, ["__n0", "__start"])
    rank = F.when(F.col("__r") == 1, F.coalesce("__start", F.lit(1))).otherwise(
        F.coalesce("__n0", F.lit(0)) + F.col("__r")
    )
    return joined.withColumn(rank_as, rank.cast("bigint")).drop("__r", "__n0", "__start", BLOCK, PLACE)


def tile_of(row_number: Column, row_count: Column, tiles: int) -> Column:
    """``NTILE``: the first ``row_count % tiles`` tiles hold one row more."""
    small = F.floor(row_count / tiles)
    larger = row_count % tiles
    in_larger = larger * (small + 1)
    return F.when(
        row_number <= in_larger, F.floor((row_number - 1) / (small + 1)) + 1
    ).otherwise(
        larger + F.floor(F.try_divide(row_number - in_larger - 1, small)) + 1
    ).cast("bigint")


def running_by_day(
    df: DataFrame, key: str, day: str, value: str, *, total_as: str
) -> DataFrame:
    """Running sum per key where all rows of a day share one total (RANGE frame).

    Days are summed first, so the window holds one row per key and day however
    many rows a key has; the totals are then looked up by (key, day).
    """
    daily = df.groupBy(key, day).agg(F.sum(value).alias("__sum"))
    frame = Window.partitionBy(key).orderBy(asc(day)).rangeBetween(Window.unboundedPreceding, 0)
    totals = daily.select(key, day, F.sum("__sum").over(frame).alias(total_as))
    return _attach(df, totals, [key, day], [total_as])
