"""Rolling statistics over an event-time range, linear in the number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .aggregate import scalar

MICROS = 1_000_000

# Mergeable parts of a set of readings, and how two sets merge.
PARTS = {"n": F.sum, "s": F.sum, "q": F.sum, "lo": F.min, "hi": F.max}

def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def rolling_stats(
    df: DataFrame, key: str, ts: str, value: str, *, seconds: int, slots: int = 60
) -> DataFrame:
    """Mean, population deviation and count of the last ``seconds`` up to each row, ties included.

    The frame is ``[ts - seconds, ts]`` per key; ``key`` and ``ts`` must not be NULL. A plain
    RANGE window re-reads the whole frame for every row and keeps a key in one task. Here a
    task holds one (key, slot) of ``seconds / slots`` at a time, and reads it once per end of
    the frame, whatever its size.
    """
    if seconds % slots:
        raise ValueError("seconds must be a multiple of slots")
    centre = scalar(df, F.avg(value))  # keeps the squares small
    x = F.col(value) - centre
    own = {"n": F.lit(1).cast("bigint"), "s": x, "q": x * x, "lo": F.col(value), "hi": F.col(value)}
    rows = df.withColumns({"__t": micros(ts), **{f"__{k}": part for k, part in own.items()}})

    framed = _framed(rows, key, seconds, slots)

    mean = F.col("__all_s") / F.col("__all_n")
    variance = F.col("__all_q") / F.col("__all_n") - mean * mean
    deviation = F.when(F.col("__all_lo") == F.col("__all_hi"), F.lit(0.0)).otherwise(
        F.sqrt(F.greatest(variance, F.lit(0.0)))
    )
    return framed.select(
        *df.columns,
        F.col("__all_n").alias("rolling_count"),
        (mean + centre).alias("rolling_avg"),
        deviation.alias("rolling_stddev"),
    )


def _framed(rows: DataFrame, key: str, seconds: int, slots: int) -> DataFrame:
    """Each row with the merged parts (``__all_*``) of its frame.

    Full slots between the two ends come from per-slot sums, one row per key and slot. The
    row's own slot is a running sum up to the row. The slot at the far end is a running sum
    backwards, over copies of its rows moved one range ahead to meet the rows that need them.
    """
    step, span = seconds // slots * MICROS, seconds * MICROS
    rows = rows.withColumn("__slot", F.floor(F.col("__t") / step))
    at = lambda own, t, slot: F.struct(F.lit(own).alias("__own"), t.alias("__t"), slot.alias("__slot"))
    twice = F.explode(F.array(
        at(True, F.col("__t"), F.col("__slot")), at(False, F.col("__t") + span, F.col("__slot") + slots)))
    both = rows.withColumn("__at", twice).drop("__t", "__slot").select("*", "__at.*").drop("__at")

    def running(prefix: str, mine: Column, order: Column) -> dict[str, Column]:
        frame = Window.partitionBy(key, "__slot").orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
        return {f"__{prefix}_{k}": merge(F.when(mine, F.col(f"__{k}"))).over(frame) for k, merge in PARTS.items()}

    edges = both.withColumns(running("near", F.col("__own"), F.asc("__t")))
    edges = edges.withColumns(running("far", ~F.col("__own"), F.desc("__t"))).where("__own")

    per_slot = rows.groupBy(key, "__slot").agg(*[merge(f"__{k}").alias(f"__{k}") for k, merge in PARTS.items()])
    # a frame reaches into the stretch of slots before its own: each slot stands in its own stretch and the next one
    stretch = F.floor(F.col("__slot") / slots)
    placed = per_slot.withColumn("__home", stretch).withColumn("__stretch", F.explode(F.array(stretch, stretch + 1)))
    inner = Window.partitionBy(key, "__stretch").orderBy("__slot").rangeBetween(-(slots - 1), -1)
    middle = placed.select(
        F.col(key).alias("__mid_key"),
        F.col("__slot").alias("__mid_slot"),
        (F.col("__home") == F.col("__stretch")).alias("__mid_own"),
        *[merge(f"__{k}").over(inner).alias(f"__mid_{k}") for k, merge in PARTS.items()],
    ).where("__mid_own")
    # plain equality on the windows' own keys: the rows are not shuffled again
    same = (edges[key] == middle["__mid_key"]) & (edges["__slot"] == middle["__mid_slot"])
    joined = edges.join(middle, same, "left")

    def whole(k: str) -> Column:
        parts = [F.col(f"__{p}_{k}") for p in ("near", "mid", "far")]
        if PARTS[k] is F.min:
            return F.least(*parts)
        if PARTS[k] is F.max:
            return F.greatest(*parts)
        return parts[0] + F.coalesce(parts[1], F.lit(0)) + F.coalesce(parts[2], F.lit(0))

    kept = [c for c in rows.columns if c not in ("__own", "__slot", *[f"__{k}" for k in PARTS])]
    return joined.select(*kept, *[whole(k).alias(f"__all_{k}") for k in PARTS])
