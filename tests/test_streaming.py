"""Streams over dropped files: replays, late rows, retries, alerts, running totals."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tallyforge.plans import sensors, social
from tallyforge.plans.inputs import load
from tallyforge.sources import folders, readers, schemas, updates, versions, writers
from tallyforge.sources.store import UpsertStore
from tallyforge.streaming import jobs, sinks, state

DATA = "/root/testdata/sf0.001"


def drop(folder, batches):
    """One JSON file per batch, with rising modification times."""
    os.makedirs(folder)
    start = time.time() - 1000
    for n, rows in enumerate(batches):
        path = f"{folder}/{n:03}.json"
        with open(path, "w") as out:
            out.writelines(json.dumps(row) + "\n" for row in rows)
        os.utime(path, (start + n, start + n))
    return folder


def run(stream, sink, folder, mode="append"):
    jobs.start(stream, sink, f"{folder}/checkpoint", mode=mode).awaitTermination()


def tag(at, *tags):
    return {"hashtags": list(tags), "timestamp": f"2024-01-01T{at}"}


def event_stream(spark, path):
    stream = readers.stream_json_dir(spark, path, schemas.SOCIAL_EVENT, files_per_trigger=1)
    return stream.withColumn("ts", F.col("timestamp").try_cast("timestamp"))


TAG_FILES = [
    [tag("00:00:10", "a", "b"), tag("00:06:00", "a")],
    [tag("00:02:00", "a"), tag("00:20:00", "z")],
    [tag("00:03:00", "late"), tag("00:16:00", "a")],
    [tag("00:01:00", "dropped"), tag("00:21:00", "z")],
]


def test_update_mode_replay_with_late_rows(spark, folder):
    stream = event_stream(spark, drop(f"{folder}/in", TAG_FILES)).withWatermark("ts", "5 minutes")
    counts = social.count_mentions(social.hashtag_mentions(stream), "5 minutes")
    run(counts, updates.log_updates(f"{folder}/log"), folder, "update")
    log = updates.read_log(spark, f"{folder}/log")
    rows = {(r.batch_id, str(r.window_start)[11:16], r.hashtag, r.mention_count) for r in log.collect()}
    assert {r for r in rows if r[0] < 3} == {
        (0, "00:00", "a", 1), (0, "00:00", "b", 1), (0, "00:05", "a", 1),
        (1, "00:00", "a", 2), (1, "00:20", "z", 1),
        (2, "00:00", "late", 1), (2, "00:15", "a", 1),
    }
    assert "dropped" not in {r[2] for r in rows}  # older than the watermark of the batch before
    assert (3, "00:20", "z", 2) in rows
    versions = updates.history(log, ["window_start", "hashtag"]).where("hashtag = 'a'")
    first = sorted((r.version, r.is_correction) for r in versions.collect() if str(r.window_start)[11:16] == "00:00")
    assert first == [(1, False), (2, True)]


def test_append_mode_emits_closed_windows_once(spark, folder):
    stream = event_stream(spark, drop(f"{folder}/in", TAG_FILES)).withWatermark("ts", "5 minutes")
    counts = social.count_mentions(social.hashtag_mentions(stream), "5 minutes")
    run(counts, updates.log_updates(f"{folder}/log"), folder, "append")
    rows = updates.read_log(spark, f"{folder}/log").collect()
    assert {(str(r.window_start)[11:16], r.hashtag, r.mention_count) for r in rows} >= {("00:00", "a", 2), ("00:00", "b", 1)}
    keys = [(r.window_start, r.hashtag) for r in rows]
    assert len(keys) == len(set(keys))


def test_three_window_sizes_in_one_stream(spark, folder):
    run(jobs.trending(event_stream(spark, drop(f"{folder}/in", TAG_FILES[:2]))), updates.log_updates(f"{folder}/log"),
        folder, "update")
    newest = updates.current(updates.read_log(spark, f"{folder}/log"), ["window_size", "window_start", "hashtag"])
    got = {(r.window_size, str(r.window_start)[11:16], r.mention_count) for r in newest.where("hashtag = 'a'").collect()}
    assert got == {
        ("1 minute", "00:00", 1), ("1 minute", "00:02", 1), ("1 minute", "00:06", 1),
        ("5 minutes", "00:00", 2), ("5 minutes", "00:05", 1), ("15 minutes", "00:00", 3),
    }


def test_versions_of_a_replay_equal_the_batch_twin(spark, folder):
    readings = load(spark, DATA, "sensor").withColumn("batch_no", F.col("reading_id") % 3)
    os.makedirs(f"{folder}/in")
    start = time.time() - 1000
    for n in range(3):
        part = f"{folder}/part{n}"
        readings.where(F.col("batch_no") == n).select("sensor_id", "temperature", F.col("ts").cast("timestamp")).coalesce(
            1).write.parquet(part)
        source = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        with open(f"{part}/{source}", "rb") as src, open(f"{folder}/in/{n}.parquet", "wb") as out:
            out.write(src.read())
        os.utime(f"{folder}/in/{n}.parquet", (start + n, start + n))
    stream = spark.readStream.schema(schemas.SENSOR_READING).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    run(jobs.sensor_windows(stream, "60 days", "1 hour"), updates.log_updates(f"{folder}/log"), folder, "update")
    versions = updates.history(updates.read_log(spark, f"{folder}/log"), ["window_start", "sensor_id"])
    columns = ["window_start", "sensor_id", "reading_count", "version", "is_correction"]

    def rows(frame):
        return sorted((*[str(r[c]) for c in columns], round(r.avg_temp, 5)) for r in frame.collect())

    twin = sensors.window_versions(readings, "batch_no")
    assert rows(versions) == rows(twin)
    assert versions.where("is_correction").count() > 0


def test_ranking_is_replaced_on_every_batch(spark, folder):
    def act(kind, user):
        return {"event_type": kind, "target_user_id": user}

    path = drop(f"{folder}/in", [[act("LIKE", "u1"), act("FOLLOW", "u2"), act("SHARE", None)],
                                 [act("SHARE", "u1"), act("SHARE", "u1"), act("VIDEO_VIEW", "u3")]])
    run(jobs.engagement(event_stream(spark, path)), sinks.rank_users(f"{folder}/log"), folder, "complete")
    newest = versions.read(spark, f"{folder}/log").collect()
    assert {(r.user_id, r.total_engagement, r["rank"]) for r in newest} == {("u1", 11, 1), ("u2", 10, 2)}


def test_engagement_options(spark):
    rows = [("LIKE", None, "p1", "2024-01-01 00:01:00"), ("VIDEO_VIEW", "u2", "p1", "2024-01-01 00:16:00"),
            ("LIKE", "u2", None, "2024-01-01 00:16:00")]
    events = spark.createDataFrame(rows, "event_type string, target_user_id string, post_id string, t string").withColumn(
        "ts", F.col("t").cast("timestamp"))
    owners = spark.createDataFrame([("p1", "u7")], "post_id string, user_id string")
    got = social.influencer_ranking(events, owners=owners).collect()
    assert {(r.user_id, r.total_engagement, r["rank"]) for r in got} == {("u7", 1, 1), ("u2", 1, 1)}
    weights = {"LIKE": 1.0, "VIDEO_VIEW": 0.5}
    got = social.influencer_ranking(events, weights=weights, owners=owners, size="15 minutes").collect()
    assert {(r.user_id, r.total_engagement, str(r.window_start)[11:], r["rank"]) for r in got} == {
        ("u7", 1.0, "00:00:00", 1), ("u2", 1.5, "00:15:00", 1)
    }


def test_landing_writes_dead_letters(spark, folder):
    good = {"event_id": "1", "event_type": "FOLLOW", "user_id": "u", "timestamp": "2024-01-01T00:00:00"}
    bad = {"event_id": "2", "event_type": "LIKE", "user_id": "u", "timestamp": "never"}
    stream = jobs.landing(event_stream(spark, drop(f"{folder}/in", [[good], [bad]])))
    run(stream, sinks.land(f"{folder}/raw", f"{folder}/dead"), folder)
    raw = {r.event_id: r for r in spark.read.parquet(f"{folder}/raw").collect()}
    assert raw["1"].is_valid and not raw["2"].is_valid
    assert raw["2"].event_timestamp == raw["2"].ingested_at  # no usable time: time of ingestion
    dead = spark.read.schema("event_id string, validation_errors string").json(f"{folder}/dead").collect()
    assert [(d.event_id, d.validation_errors) for d in dead] == [
        ("2", "missing post_id for event type that requires it")]


def test_viral_threshold(spark, folder):
    like = {"event_type": "LIKE", "post_id": "p", "timestamp": "2024-01-01T00:01:00"}
    path = drop(f"{folder}/in", [[like] * 3, [like] * 2 + [{**like, "post_id": "q"}, {**like, "post_id": None}]])
    run(jobs.likes(event_stream(spark, path)), sinks.keep_viral(f"{folder}/log", 4), folder, "update")
    rows = updates.read_log(spark, f"{folder}/log").collect()
    assert [(r.post_id, r.like_count, r.batch_id) for r in rows] == [("p", 5, 1)]


AMOUNTS = [("C100", 500.0), ("C200", 15000.0), ("C100", 12000.0), ("C300", 9999.99), ("C200", 22000.0),
           ("C100", 300.0), ("C100", 18000.0), ("C300", 50000.0), ("C200", 11000.0), ("C300", 7500.0)]
TXN = schemas.table(transaction_id="bigint", customer_id="string", amount="double")
OFFSET_TXN = schemas.table(transaction_id="bigint", customer_id="string", amount="double", offset="bigint")


def transactions(amounts):
    return [{"transaction_id": i, "customer_id": c, "amount": a} for i, (c, a) in enumerate(amounts, 1)]


def totals(frame):
    return {(r.latest_transaction_id, r.customer_id, r.running_total, r.transactions_counted) for r in frame.collect()}


def test_running_totals_golden(spark, folder):
    expected = {(2, "C200", 15000.0, 1), (3, "C100", 12000.0, 1), (5, "C200", 37000.0, 2), (7, "C100", 30000.0, 2),
                (8, "C300", 50000.0, 1), (9, "C200", 48000.0, 3)}
    rows = transactions(AMOUNTS)
    path = drop(f"{folder}/in", [rows[5::-1], rows[6:]])  # unordered within a batch
    stream = readers.stream_json_dir(spark, path, TXN, files_per_trigger=1)
    published = []
    sink = sinks.running_totals(
        f"{folder}/log", f"{folder}/totals", arrival=["transaction_id"], publish=lambda m: published.extend(m.collect()))
    run(jobs.high_value(stream), sink, folder)
    assert totals(updates.read_log(spark, f"{folder}/log")) == expected
    assert len(published) == 6 and {m.key for m in published} == {"C100", "C200", "C300"}
    batch = spark.createDataFrame([tuple(r.values()) for r in rows], TXN)
    assert totals(sensors.high_value_running_totals(batch, blocks=3)) == expected


@pytest.mark.parametrize("snapshot_every", [1, 2, 20])
def test_running_totals_over_snapshots_and_a_retry(spark, folder, snapshot_every):
    rows = transactions([("hot" if i % 3 else f"c{i % 4}", 10_001.0 + i) for i in range(40)])
    batches = [rows[n:n + 8] for n in range(0, 40, 8)]
    sink = sinks.running_totals(
        f"{folder}/log", f"{folder}/totals", arrival=["transaction_id"], snapshot_every=snapshot_every)
    for n, part in enumerate(batches):
        frame = spark.createDataFrame([tuple(r.values()) for r in part], TXN)
        sink(frame, n)
        if n == 3:
            sink(frame, n)  # the batch failed after writing and runs again
    whole = spark.createDataFrame([tuple(r.values()) for r in rows], TXN)
    assert totals(updates.read_log(spark, f"{folder}/log")) == totals(sensors.high_value_running_totals(whole))


def test_merged_batches(spark, folder):
    path = drop(f"{folder}/in", [transactions(AMOUNTS[:5]), transactions(AMOUNTS)[5:]])
    stream = readers.stream_json_dir(spark, path, TXN, files_per_trigger=1)
    run(stream, sinks.merge(f"{folder}/log", "transaction_id", size=3), folder)
    rows = updates.read_log(spark, f"{folder}/log").collect()
    assert sorted((r.batch_id, r.batch_no, r.record_count) for r in rows) == [(0, 0, 3), (0, 1, 2), (1, 0, 3), (1, 1, 2)]
    assert sorted(e["transaction_id"] for r in rows for e in json.loads(r.records)) == list(range(1, 11))


def test_sensor_alerts_by_state(spark, folder):
    calm = [{"sensor_id": "s", "temperature": 20.0 + n % 3 / 10, "ts": f"2024-01-01T00:{n + 10}:00"} for n in range(40)]
    few = [{"sensor_id": "t", "temperature": t, "ts": "2024-01-01T00:30:00"} for t in (20.0, 90.0)]
    gaps = [{"sensor_id": None, "temperature": 1.0, "ts": "2024-01-01T00:30:00"}, {"sensor_id": "s", "ts": "2024-01-01T00:30:00"}]
    spike = [{"sensor_id": "s", "temperature": 40.0, "ts": "2024-01-01T00:59:00"}]
    later = [{"sensor_id": "s", "temperature": 41.0, "ts": "2024-01-01T01:49:00"}]  # only slots 00:50 to 01:49 count now
    published = []
    path = drop(f"{folder}/in", [calm + few + gaps, spike, later])
    stream = readers.stream_json_dir(spark, path, schemas.SENSOR_READING, files_per_trigger=1)
    run(state.sensor_alerts(stream, delay="2 hours"), sinks.alerts(f"{folder}/alerts", lambda m: published.extend(m.collect())), folder)
    alerts = spark.read.parquet(f"{folder}/alerts").collect()
    assert [(a.sensor_id, a.temperature, a.rolling_count) for a in alerts] == [("s", 40.0, 41)]
    values = [r["temperature"] for r in calm] + [40.0]
    mean = sum(values) / 41
    deviation = (sum((v - mean) ** 2 for v in values) / 41) ** 0.5
    assert (alerts[0].rolling_avg, alerts[0].threshold) == (round(mean, 3), round(mean + 3 * deviation, 3))
    assert [json.loads(m.value)["temperature"] for m in published] == [40.0] and published[0].key == "s"
    run(state.sensor_alerts(stream, delay="2 hours"), sinks.alerts(f"{folder}/alerts"), folder)  # taken up again: nothing new
    assert spark.read.parquet(f"{folder}/alerts").count() == 1


def test_moments_merge_like_one_pass():
    import numpy as np
    rng = np.random.default_rng(3)
    values, slots = rng.normal(50, 5, 1000), rng.integers(0, 7, 1000)
    total = (0, 0.0, 0.0)
    for begin in range(0, 1000, 130):
        for found in state.moments_of(slots[begin:begin + 130], values[begin:begin + 130]).values():
            total = state.merged(total, found)
    assert total[0] == 1000 and abs(total[1] - values.mean()) < 1e-9 and abs(total[2] / 1000 - values.var()) < 1e-9


@pytest.mark.parametrize("cuts", [[0, 40], [0, 1, 2, 13, 14, 30, 40]])
def test_running_totals_by_state(spark, folder, cuts):
    rows = transactions([("hot" if i % 3 else f"c{i % 4}", 10_001.1 + i / 7) for i in range(40)])
    rows = [{**r, "offset": 100 - i if i % 2 else i} for i, r in enumerate(rows)]
    rows = sorted(rows, key=lambda r: r["offset"])
    path = drop(f"{folder}/in", [rows[a:b][::-1] for a, b in zip(cuts, cuts[1:])])  # disordered within a batch
    stream = readers.stream_json_dir(spark, path, OFFSET_TXN, files_per_trigger=1)
    run(state.running_totals(jobs.high_value(stream, arrival=["offset"]), ["offset"]), updates.log_updates(f"{folder}/log"), folder)
    want, held = set(), {}
    for r in rows:
        if r["amount"] > 10_000:
            total, n = held.get(r["customer_id"], (0.0, 0))
            held[r["customer_id"]] = total, n = total + r["amount"], n + 1
            want.add((r["transaction_id"], r["customer_id"], round(total, 2), n))
    assert {(i, c, round(t, 2), n) for i, c, t, n in totals(updates.read_log(spark, f"{folder}/log"))} == want
    with pytest.raises(ValueError):
        state.running_totals(stream, [])


def test_running_totals_call_python_once_a_part(spark, folder):
    """Many customers of few rows: a call per customer cost more than all of its rows."""
    rows = [{**r, "offset": i} for i, r in enumerate(transactions([(f"c{i % 300}", 10_001.0 + i) for i in range(900)]))]
    path = drop(f"{folder}/in", [rows[:450], rows[450:]])
    stream = readers.stream_json_dir(spark, path, OFFSET_TXN, files_per_trigger=1)
    found = state.running_totals(jobs.high_value(stream, arrival=["offset"]), ["offset"], parts=3)
    query = jobs.start(found, updates.log_updates(f"{folder}/log"), f"{folder}/checkpoint")
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(states) == 3
    held, want = {}, set()
    for r in rows:
        total, n = held.get(r["customer_id"], (0.0, 0))
        held[r["customer_id"]] = total, n = total + r["amount"], n + 1
        want.add((r["transaction_id"], r["customer_id"], round(total, 2), n))
    assert {(i, c, round(t, 2), n) for i, c, t, n in totals(updates.read_log(spark, f"{folder}/log"))} == want


def test_store_folds_its_tail(spark, folder):
    store, log = UpsertStore(f"{folder}/store", ["a", "b"], fold_every=3), {}
    versions_seen = []
    for batch_id in range(20):
        rows = [(f"k{i}" if i else None, i % 2, batch_id * 100 + i) for i in range(6) if (batch_id + i) % (i + 1) == 0]
        frame = spark.createDataFrame(rows, "a string, b int, value int")
        store.write(frame, batch_id)
        if batch_id in (2, 7):
            store.write(frame, batch_id)  # a retry, folded already or not
        for a, b, value in rows:
            log.setdefault((a, b), []).append(value)
        assert len(folders.children(spark, f"{folder}/store/tail")) <= 6
        assert len(folders.numbered(spark, f"{folder}/store/snapshot/_published")) <= 2
        if batch_id % 6 == 5 or batch_id in (0, 3):
            now = {(r.a, r.b): (r.value, r.version) for r in store.current(spark).collect()}
            assert now == {key: (values[-1], len(values)) for key, values in log.items()}
            versions_seen = {(r.a, r.b, r.version, r.value, r.is_correction) for r in store.history(spark).collect()}
            assert versions_seen == {(*key, n, value, n > 1) for key, values in log.items() for n, value in enumerate(values, 1)}
    plan = store.current(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.replace("SortMerge", "Sort")  # hash aggregates and hash joins only


def test_versions_survive_a_failed_reload(spark, folder):
    path = f"{folder}/table"
    assert versions.publish(spark.range(3), path) == 0
    bad = spark.range(4).select(F.expr("CAST(CASE WHEN id = 3 THEN raise_error('lost') ELSE id END AS bigint)").alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(bad, path)
    assert versions.read(spark, path).count() == 3
    for n in range(1, 6):
        assert versions.publish(spark.range(n), path) == n
    assert versions.publish(spark.range(99), path, 5) == 5  # a retry
    assert versions.read(spark, path).count() == 5 and folders.numbered(spark, path, "version=") == [4, 5]
    with pytest.raises(ValueError):
        versions.read(spark, f"{folder}/none")


def test_console_and_interval_trigger(spark, folder):
    stream = event_stream(spark, drop(f"{folder}/in", TAG_FILES[:1]))
    query = jobs.start(jobs.sentiments(stream), "console", f"{folder}/checkpoint", every=jobs.CURATED_TRIGGER)
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def test_topic_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        readers.stream_topic(spark, "nowhere:1", "events")


def test_dead_letters_of_a_batch_frame(spark, folder):
    frame = spark.createDataFrame([("1", True), ("2", False)], "event_id string, is_valid boolean")
    for _ in range(2):
        writers.write_dead_letters(frame, f"{folder}/dead", 5)
    assert [r.event_id for r in spark.read.schema("event_id string").json(f"{folder}/dead").collect()] == ["2"]


def test_running_totals_do_not_depend_on_batch_cuts(spark, folder):
    rows = [("C1", "T9", 20_000.0, 0, 1), ("C1", "T10", 30_000.0, 0, 2)]
    schema = "customer_id string, transaction_id string, amount double, message_partition int, message_offset long"
    found = []
    for name, batches in (("one", [rows]), ("two", [rows[:1], rows[1:]])):
        sink = sinks.running_totals(
            f"{folder}/{name}", f"{folder}/{name}-totals", arrival=["message_partition", "message_offset"])
        for batch_id, batch in enumerate(batches):
            sink(spark.createDataFrame(batch, schema), batch_id)
        log = updates.read_log(spark, f"{folder}/{name}").collect()
        found.append({r.latest_transaction_id: (r.running_total, r.transactions_counted) for r in log})
    assert found == [{"T9": (20_000.0, 1), "T10": (50_000.0, 2)}] * 2
