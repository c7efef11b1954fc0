"""Operators with state of their own per key: rolling sensor alerts and running totals.

The state lives in the stream's state store, a few numbers per key, and is committed with the batch: a retried batch
starts from the same state, nothing is listed or re-read from earlier batches, and the cost of a batch does not depend on its number.
A batch's rows of one key meet in one task; the source's rate limit (files or offsets per trigger) bounds them. Keys of running totals
share a state by hash, because a call per key costs more than its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyforge.functions.numbers import tidy
from tallyforge.plans.sensors import ALERT_DEVIATIONS, MIN_READINGS

#: States that the customers of the running totals share.
PARTS = 512


def moments_of(slot: np.ndarray, value: np.ndarray) -> dict[int, tuple[int, float, float]]:
    """Per slot: number, mean, and sum of squared deviations."""
    found, place, counts = np.unique(slot, return_inverse=True, return_counts=True)
    mean = np.bincount(place, value, len(found)) / counts
    square = np.bincount(place, (value - mean[place]) ** 2, len(found))
    return {int(s): (int(n), float(m), float(q)) for s, n, m, q in zip(found, counts, mean, square)}


def merged(one: tuple[int, float, float], other: tuple[int, float, float]) -> tuple[int, float, float]:
    n = one[0] + other[0]
    if not n:
        return 0, 0.0, 0.0
    apart = other[1] - one[1]
    return n, one[1] + apart * other[0] / n, one[2] + other[2] + apart * apart * one[0] * other[0] / n


def sensor_alerts(readings: DataFrame, *, slot: str = "1 minute", slots: int = 60, delay: str = "10 minutes") -> DataFrame:
    """A stream of alerts: readings above mean + 3 deviations of their sensor's last ``slots`` slots of event time.

    The statistics cover the slots up to the newest that the sensor has reached, this batch included; a reading older than these
    slots is compared but does not count. The state of a sensor is number, mean and squared deviations per slot, ``slots`` at
    most, whatever the number of readings; a sensor that is silent until the watermark has passed them all is forgotten.
    Readings behind the watermark, and those without sensor, temperature or time, are left out.
    """
    micros = int(readings.sparkSession.sql(f"SELECT CAST(unix_micros(timestamp'1970-01-01 00:00:00Z' + INTERVAL {slot}) AS bigint)").first()[0])
    known = readings.withWatermark("ts", delay).where("sensor_id IS NOT NULL AND temperature IS NOT NULL AND ts IS NOT NULL").select(
        "sensor_id", F.col("temperature").cast("double").alias("temperature"), F.unix_micros("ts").alias("at"), "ts")

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = {s: (n, m, q) for s, n, m, q in zip(*state.get)} if state.exists else {}
        times, values = [], []
        for frame in frames:
            times.append(frame["at"].to_numpy(np.int64))
            values.append(frame["temperature"].to_numpy(float))
            for s, found in moments_of(times[-1] // micros, values[-1]).items():
                held[s] = merged(held[s], found) if s in held else found
            oldest = max(held) - slots
            held = {s: found for s, found in held.items() if s > oldest}
        order = sorted(held)
        total = (0, 0.0, 0.0)
        for s in order:
            total = merged(total, held[s])
        state.update((order, *[[held[s][at] for s in order] for at in range(3)]))
        state.setTimeoutTimestamp(max((order[-1] + slots + 1) * micros // 1000, state.getCurrentWatermarkMs() + 1))
        n, mean, deviation = total[0], total[1], (total[2] / total[0]) ** 0.5
        at, value = np.concatenate(times), np.concatenate(values)
        high = np.flatnonzero(value > mean + ALERT_DEVIATIONS * deviation) if n >= MIN_READINGS and deviation > 0 else []
        if len(high):
            yield pd.DataFrame({"sensor_id": key[0], "temperature": value[high], "rolling_avg": mean, "rolling_stddev": deviation,
                                "rolling_count": n, "at": at[high]})

    kind = known.schema["sensor_id"].dataType.simpleString()
    alerts = known.groupBy("sensor_id").applyInPandasWithState(
        run, f"sensor_id {kind}, temperature double, rolling_avg double, rolling_stddev double, rolling_count bigint, at bigint",
        "slot array<bigint>, n array<bigint>, mean array<double>, square array<double>", "append", GroupStateTimeout.EventTimeTimeout)
    return alerts.select(
        "sensor_id", "temperature", tidy(F.col("rolling_avg"), 3).alias("rolling_avg"),
        tidy(F.col("rolling_stddev"), 3).alias("rolling_stddev"),
        tidy(F.col("rolling_avg") + ALERT_DEVIATIONS * F.col("rolling_stddev"), 3).alias("threshold"), "rolling_count",
        F.timestamp_micros("at").alias("event_ts"))


def running_totals(transactions: DataFrame, arrival: Sequence[str], parts: int = PARTS) -> DataFrame:
    """A stream of running total and count per customer, one row per transaction, in the order of arrival.

    ``arrival`` names the columns that give this order, such as a message's partition and offset; it is required, because without
    it totals would depend on how the stream was cut into batches. The state of a customer is total and count.

    Customers are dealt to ``parts`` parts by hash, and a part's customers lie in one state, so that a batch calls Python once per part
    instead of once per customer. A checkpoint holds the number of parts it was begun with.
    """
    if not arrival:
        raise ValueError("name the columns of the order of arrival")
    rows = transactions.select(F.col("customer_id").cast("string").alias("customer_id"), "transaction_id",
                               F.col("amount").cast("double").alias("amount"), F.struct(*arrival).alias("arrival"))
    rows = rows.select("customer_id", "transaction_id", "amount", *[F.col(f"arrival.{c}").alias(f"__by_{i}") for i, c in enumerate(arrival)])
    rows = rows.withColumn("__part", F.pmod(F.xxhash64("customer_id"), F.lit(parts)))
    by = [f"__by_{i}" for i in range(len(arrival))]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(frames)).sort_values(by, kind="stable")
        held = {customer: (total, n) for customer, total, n in zip(*state.get)} if state.exists else {}
        customers, sums, counts = frame["customer_id"].tolist(), [], []
        # one by one from the total before, so that a cut between batches changes no sum
        for customer, amount in zip(customers, frame["amount"].tolist()):
            total, n = held.get(customer, (0.0, 0))
            held[customer] = total + amount, n + 1
            sums.append(total + amount)
            counts.append(n + 1)
        state.update((list(held), [total for total, _ in held.values()], [n for _, n in held.values()]))
        yield pd.DataFrame({
            "customer_id": customers, "running_total": sums, "latest_transaction_id": frame["transaction_id"].to_numpy(),
            "latest_amount": frame["amount"].to_numpy(), "transactions_counted": counts})

    kind = rows.schema["transaction_id"].dataType.simpleString()
    found = rows.groupBy("__part").applyInPandasWithState(
        run, f"customer_id string, running_total double, latest_transaction_id {kind}, latest_amount double, transactions_counted bigint",
        "customer array<string>, total array<double>, n array<bigint>", "append", GroupStateTimeout.NoTimeout)
    return found.withColumn("running_total", tidy(F.col("running_total")))
