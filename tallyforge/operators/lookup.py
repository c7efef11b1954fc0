"""Left lookups into a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, dim: DataFrame, key: str, values: dict[str, str], *, spread: int = 512) -> DataFrame:
    """Left join ``facts`` to the dimension's ``values`` (``{column: new name}``) on ``key``.

    A fact meets one row at most: of several dimension rows with its key, the one with the
    largest values (in the order they are named, NULL smallest).

    No side is forced into memory: Spark broadcasts the dimension only when its size
    allows it, and otherwise splits hot keys while joining. Facts without a key would all
    meet in one task, so they get one of ``spread`` stand-in keys; the join condition keeps
    those from matching anything.
    """
    newest = F.max(F.struct(*[F.col(c).alias(n) for c, n in values.items()])).alias("__row")
    slim = dim.groupBy(F.col(key).cast("string").alias("__dim_key")).agg(newest).select("__dim_key", "__row.*")
    hashable = [c for c, kind in facts.dtypes if "map<" not in kind]
    stand_in = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*hashable), F.lit(spread)))
    keyed = facts.withColumn("__key", F.coalesce(F.col(key).cast("string"), stand_in))
    matches = (F.col("__key") == F.col("__dim_key")) & keyed[key].isNotNull()
    return keyed.join(slim, matches, "left").drop("__key", "__dim_key")
