"""Block-wise ranks and sums against brute force, with hot keys, ties and NULL keys."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.operators import ordered
from tallyforge.operators.aggregate import rank_by_level
from tallyforge.operators.lookup import lookup
from tallyforge.operators.rolling import rolling_stats

SCHEMA = "k string, id long, v double"


def skewed(n=900, seed=7):
    """A third of the rows under one key, a third of those with one value, some without a key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 31 == 0 else rng.choice("abcdefg")
        value = 5.0 if i % 9 == 0 else float(rng.randrange(40))
        rows.append((key, i, value))
    rng.shuffle(rows)
    return rows


def by_key(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("blocks", [1, 2, 7, 40])
def test_number_rows(spark, blocks):
    rows = skewed()
    order = [ordered.asc("id")]
    placed = ordered.place_in_blocks(spark.createDataFrame(rows, SCHEMA), [ordered.asc("k"), *order], blocks)
    got = ordered.number_rows(placed, ["k"], order, number_as="n", sums={"run": "v"}).collect()
    expected = set()
    for key, group in by_key(rows).items():
        total = 0.0
        for n, (_, i, v) in enumerate(sorted(group, key=lambda r: r[1]), 1):
            total += v
            expected.add((key, i, v, n, total))
    assert {(r.k, r.id, r.v, r.n, r.run) for r in got} == expected
    assert len(got) == len(rows)


@pytest.mark.parametrize("blocks", [1, 3, 9, 60])
def test_rank_rows_with_ties_over_blocks(spark, blocks):
    rows = skewed()
    order = [ordered.asc("k"), ordered.desc("v"), ordered.asc("id")]
    placed = ordered.place_in_blocks(spark.createDataFrame(rows, SCHEMA), order, blocks)
    got = ordered.rank_rows(placed, ["k"], "v", rank_as="r").collect()
    expected = set()
    for key, group in by_key(rows).items():
        for _, i, v in group:
            expected.add((key, i, 1 + sum(other[2] > v for other in group)))
    assert {(r.k, r.id, r.r) for r in got} == expected
    assert len(got) == len(rows)


def test_rank_rows_all_equal(spark):
    frame = spark.createDataFrame([("a", i, 1.0) for i in range(200)] + [("a", 999, 0.0)], SCHEMA)
    placed = ordered.place_in_blocks(frame, [ordered.asc("k"), ordered.desc("v"), ordered.asc("id")], 8)
    got = ordered.rank_rows(placed, ["k"], "v", rank_as="r").groupBy("r").count().collect()
    assert {(r.r, r["count"]) for r in got} == {(1, 200), (201, 1)}


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("blocks", [1, 4])
def test_numbers_go_on_over_batches_nulls_and_nan(spark, small_batches, blocks):
    rng = random.Random(2)
    nan = float("nan")
    rows = [(rng.choice([1.0, nan, None, -0.0, 0.0]), i, rng.choice([None, 1, 2]), rng.choice([None, nan, 4.0])) for i in range(120)]
    frame = spark.createDataFrame(rows, "k double, id long, n int, v double").withColumn("extra", F.array("id"))
    frame = frame.withColumn("v", F.when(F.isnan("v"), 0.5).otherwise(F.col("v")))
    placed = ordered.place_in_blocks(frame, [ordered.asc("k"), ordered.asc("id")], blocks)
    got = ordered.number_rows(placed, ["k"], [ordered.asc("id")], number_as="at", sums={"ran": "n", "run": "v"})
    window = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    plain = frame.select("*", F.row_number().over(window).cast("bigint").alias("at"),
                         F.sum("n").over(window).alias("ran"), F.sum("v").over(window).alias("run"))
    assert got.dtypes == plain.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("blocks", [1, 6])
def test_ranks_go_on_over_batches(spark, small_batches, blocks):
    nan = float("nan")
    rows = [("hot" if i % 3 else None, i, [nan, None, 2.0, 2.0, 1.0][i % 5]) for i in range(90)]
    frame = spark.createDataFrame(rows, SCHEMA)
    placed = ordered.place_in_blocks(frame, [ordered.asc("k"), ordered.desc("v"), ordered.asc("id")], blocks)
    got = ordered.rank_rows(placed, ["k"], "v", rank_as="r")
    plain = frame.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(ordered.desc("v"))).cast("bigint"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_placed_rows_are_not_shuffled_again(spark):
    wide = spark.createDataFrame(skewed(), SCHEMA).withColumn("payload", F.concat(F.lit("p"), "id"))
    order = [ordered.asc("k"), ordered.desc("v"), ordered.asc("id")]
    placed = ordered.place_in_blocks(wide, order, 4)
    numbered = ordered.number_rows(placed, ["k"], order[1:], number_as="n", sums={"run": "v"})
    for df in (numbered, ordered.rank_rows(placed, ["k"], "v", rank_as="r"), ordered.number_rows(placed, [], order, number_as="n")):
        assert "payload" in df.columns
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = df.select("*")._jdf.queryExecution().executedPlan()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert not [1 for node in shuffles(plan) if "payload" in node.output().mkString(",")]


def shuffles(node):
    """The shuffles of a physical plan."""
    if node.nodeName() == "Exchange":
        yield node
    children = node.children()
    for at in range(children.size()):
        yield from shuffles(children.apply(at))


def test_running_sums_take_numbers_only(spark):
    frame = spark.createDataFrame([(1, "a")], "id long, v string")
    placed = ordered.place_in_blocks(frame, [ordered.asc("id")], 1)
    with pytest.raises(TypeError, match="running sum of v"):
        ordered.number_rows(placed, [], [ordered.asc("id")], number_as="n", sums={"run": "v"})


@pytest.mark.parametrize("n", [3, 10, 11, 19, 100, 103])
def test_tiles_equal_ntile(spark, n):
    frame = spark.range(n).withColumn("p", F.col("id") + 1)
    both = frame.select(
        F.ntile(10).over(Window.orderBy("p")).alias("a"), ordered.tile_of(F.col("p"), F.lit(n), 10).alias("b")
    )
    assert both.where("a <> b").count() == 0


def test_running_by_day_shares_the_total_of_a_day(spark):
    rows = [("hot" if i % 3 == 0 else None if i % 5 == 0 else "x", i % 13, float(i)) for i in range(300)]
    frame = spark.createDataFrame(rows, "k string, day int, v double")
    got = ordered.running_by_day(frame, "k", "day", "v", total_as="t").collect()
    assert sorted((r.k or "", r.day, r.v, r.t) for r in got) == sorted(
        (k or "", d, v, sum(o[2] for o in rows if o[0] == k and o[1] <= d)) for k, d, v in rows
    )


def test_rank_by_level(spark):
    levels = [5] * 300 + [7, 7, 3, 9, None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(levels)], "id long, score long")
    got = {(r.score, r["rank"]) for r in rank_by_level(frame, "score", "rank").collect()}
    assert got == {(9, 1), (7, 2), (5, 4), (3, 304), (None, 305)}


def test_lookup_keeps_all_facts(spark):
    facts = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else None if i % 2 else f"k{i % 7}") for i in range(500)], "id long, k string")
    dim = spark.createDataFrame([("hot", 1), ("hot", 0), ("k2", 2), (None, 3), ("", 4)], "k string, v int")
    got = lookup(facts, dim, "k", {"v": "found"}, spread=8).collect()
    assert len(got) == 500
    for row in got:
        assert row.found == {"hot": 1, "k2": 2}.get(row.k)


@pytest.mark.parametrize("slots", [4, 60])
def test_rolling_stats(spark, slots):
    rng = random.Random(3)
    rows = [
        (i, "hot" if i % 3 else rng.choice("ab"), rng.randrange(0, 20_000) * 1_000_000 + rng.randrange(3), 20 + rng.random())
        for i in range(400)
    ]
    rows += [(1000 + i, "flat", i * 60_000_000, 21.3) for i in range(30)]
    rows += [(3000 + i, "hot", 5_000_000_000, 22.0 + i) for i in range(50)]  # a burst at one instant
    rows += [(2000, "hot", 0, 1.0), (2001, "hot", 3600_000_000, 2.0), (2002, "hot", 7200_000_001, 3.0)]  # frame edges
    frame = spark.createDataFrame(rows, "id long, k string, us long, v double").withColumn("ts", F.timestamp_micros("us"))
    got = {r.id: r for r in rolling_stats(frame, "k", "ts", "v", seconds=3600, slots=slots).collect()}
    assert len(got) == len(rows)
    for i, key, us, _ in rows:
        frame_values = [v for _, k, t, v in rows if k == key and us - 3600_000_000 <= t <= us]
        mean = sum(frame_values) / len(frame_values)
        std = (sum((v - mean) ** 2 for v in frame_values) / len(frame_values)) ** 0.5
        row = got[i]
        assert row.rolling_count == len(frame_values)
        assert abs(row.rolling_avg - mean) < 1e-9 and abs(row.rolling_stddev - std) < 1e-7
        if key == "flat":
            assert row.rolling_stddev == 0.0
