"""All named queries over a data folder: name -> f(spark, data_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyforge.functions import udfs
from tallyforge.functions.numbers import tidy
from tallyforge.operators.checks import source_counts
from tallyforge.operators.profile import column_roles, quality_report
from tallyforge.session import fresh_path
from tallyforge.sources import messages, readers, schemas, updates, versions, writers
from tallyforge.sources.store import UpsertStore
from tallyforge.streaming import jobs, sinks, state

from . import churn, fraud, mart, orders, sensors, social
from .inputs import BASE_TABLES, INPUTS, load
from .stored import refresh_daily_report, stored_daily_report

Query = Callable[[SparkSession, str], DataFrame]

# Time of ingestion used by the registered queries, so that results can be compared.
INGESTED_AT = "2024-02-01 00:00:00"

FRAUD = [
    fraud.fraud_overview, fraud.top_countries, fraud.top_cities, fraud.profile_columns, fraud.dimension_shares,
    fraud.top_customers, fraud.amount_by_age, fraud.fraud_by_age, fraud.dormant_accounts, fraud.country_averages,
    fraud.fraud_by_merchant, fraud.fraud_by_payment, fraud.fraud_by_device, fraud.fraud_type_share,
    fraud.fraud_timing, fraud.amount_anomalies, fraud.repeat_failures, fraud.fraud_by_pin,
    fraud.fraud_by_international, fraud.risk_ranking, fraud.country_rank, fraud.top_n_per_group,
    fraud.running_total, fraud.customer_deciles, fraud.executive_fraud_report, fraud.high_risk_view,
    fraud.daily_fraud_report, fraud.suspicious_customers, fraud.fraud_summary, fraud.fraud_alerts,
    fraud.fraud_daily_summary, fraud.fraud_business_report,
]

CHURN = [
    quality_report, column_roles, churn.total_charges_fix, churn.charge_discrepancy, churn.churn_by_demographics,
    churn.churn_by_segment, churn.churn_profiles, churn.clv_comparison, churn.churn_by_risk_score,
    churn.annual_loss, churn.pareto_summary, churn.pareto_curve, churn.arpu, churn.revenue_leakage,
    churn.revenue_leakage_summary, churn.high_payers, churn.high_payer_summary, churn.churn_by_combo,
    churn.service_effect, churn.churn_by_adoption, churn.fiber_cohort, churn.bundle_value, churn.churn_features,
    churn.retention_kpis, churn.churn_by_risk_tier, mart.stg_churn,
]

MART = ["int_customer_features", "dim_customers", "dim_services", "fct_churn", "mart_churn_kpis"]


def over(table: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, data_dir: build(load(spark, data_dir, table))


def ntz(df: DataFrame) -> DataFrame:
    """Instants as wall-clock times in the session zone, like the stored tables have them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields
    ])


def ingested() -> Column:
    return F.lit(INGESTED_AT).cast("timestamp_ntz")


# --- batch queries that need more than one table ---------------------------------------


def _model(name: str) -> Query:
    return lambda spark, data_dir: mart.models(load(spark, data_dir, "telecom"))[name]


def _churn_loss_total(spark: SparkSession, data_dir: str) -> DataFrame:
    return mart.churn_loss_total(_model("mart_churn_kpis")(spark, data_dir))


def _data_tests(spark: SparkSession, data_dir: str) -> DataFrame:
    return mart.data_tests(mart.models(load(spark, data_dir, "telecom")))


def _source_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    names = ["bank_txn", "telecom", "social", "sensor"]
    return source_counts({name: load(spark, data_dir, name) for name in names})


def _city_top_customers(spark: SparkSession, data_dir: str) -> DataFrame:
    return orders.city_top_customers(
        load(spark, data_dir, "customer_orders"), load(spark, data_dir, "city_customers")
    )


def _enrich_events(spark: SparkSession, data_dir: str) -> DataFrame:
    dims = load(spark, data_dir, "user_dim"), load(spark, data_dir, "post_dim")
    return social.enrich_events(load(spark, data_dir, "social"), *dims, ingested())


def _validate_events(events: DataFrame) -> DataFrame:
    return social.validate_events(events).select(
        "event_id", "event_type", "user_id", "post_id", "is_valid", "validation_errors"
    )


def _raw_events(events: DataFrame) -> DataFrame:
    return social.raw_events(events, ingested())


def _window_versions(readings: DataFrame) -> DataFrame:
    return sensors.window_versions(readings.withColumn("batch_no", F.col("reading_id") % 3), "batch_no")


def _sensor_windows(readings: DataFrame) -> DataFrame:
    return sensors.sensor_windows(readings).withColumn("avg_temp", tidy(F.col("avg_temp"), 6))


def _merge_records(records: DataFrame) -> DataFrame:
    merged = messages.merge_records(records, "transaction_id")
    ids = F.from_json("records", "array<struct<transaction_id: bigint>>")["transaction_id"]
    return merged.select(
        "batch_no", "record_count", "first_record", "last_record",
        F.json_array_length("records").cast("bigint").alias("array_length"), F.array_join(ids, ",").alias("record_ids"),
    )


# --- round trips through files and messages --------------------------------------------


def _written_csv(spark: SparkSession, data_dir: str, breaks: str) -> tuple[str, StructType]:
    """Transactions as CSV whose cities end in a comma and quotes, a backslash, ``breaks`` or nothing special."""
    txn, path = load(spark, data_dir, "bank_txn"), fresh_path(spark, "csv-load")
    known = StructType([f for f in schemas.BANK_TRANSACTION.fields if f.name in txn.columns])
    kind = F.col("transaction_id") % 4
    ending = F.when(kind == 0, ', "x"').when(kind == 1, "\\").when(kind == 2, breaks).otherwise("")
    rows = txn.withColumn("city", F.concat("city", ending)).select(*known.fieldNames())
    rows.write.options(header=True, nullValue="NULL", quote='"', escape='"', ignoreTrailingWhiteSpace=False).csv(f"{path}/rows")
    # lines with two fields of the many
    short = rows.where(F.col("transaction_id") % 100 == 0).select("transaction_id", "customer_id")
    short.write.options(header=True).csv(f"{path}/short")
    return f"{path}/*", known


def _csv_load(spark: SparkSession, data_dir: str) -> DataFrame:
    """Transactions written as CSV with null markers and awkward texts, read back typed."""
    path, known = _written_csv(spark, data_dir, " - ")
    return readers.read_csv(spark, path, known)


def _csv_load_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """The same with line breaks inside quotes."""
    path, known = _written_csv(spark, data_dir, "\n.")
    return readers.read_csv(spark, path, known, multi_line=True)


def _csv_rejects(spark: SparkSession, data_dir: str) -> DataFrame:
    path, known = _written_csv(spark, data_dir, " - ")
    return readers.csv_rejects(spark, path, known).agg(F.count(F.lit(1)).alias("rejected"))


def _json_scan(spark: SparkSession, data_dir: str) -> DataFrame:
    """Risk records written as JSON lines, read back with the declared schema, classified."""
    path = fresh_path(spark, "json-scan")
    load(spark, data_dir, "risk").write.json(path)
    return orders.risk_classify(readers.read_json_lines(spark, path, schemas.RISK_RECORD))


def _social_messages(spark: SparkSession, data_dir: str) -> DataFrame:
    events = load(spark, data_dir, "social").withColumnRenamed("ts", "timestamp")
    return messages.to_keyed_messages(events, "event_id")


def _decode_events(spark: SparkSession, data_dir: str) -> DataFrame:
    decoded = messages.decode_events(
        _social_messages(spark, data_dir), schemas.SOCIAL_EVENT, time_column="timestamp"
    )
    joined = F.array_join("hashtags", ",").alias("hashtags")
    plain = [c for c in schemas.SOCIAL_EVENT.fieldNames() if c not in ("hashtags", "timestamp")]
    return ntz(decoded.select(*plain, joined, "message_key", "ts"))


def _keyed_messages(spark: SparkSession, data_dir: str) -> DataFrame:
    sent = messages.to_keyed_messages(load(spark, data_dir, "user_txn"), "transaction_id")
    field = {"transaction_id": "bigint", "customer_id": "bigint", "amount": "double", "ts": "timestamp_ntz"}
    return sent.select(
        "key", *[F.get_json_object("value", f"$.{n}").cast(t).alias(n) for n, t in field.items()]
    )


def _partitioned_write(spark: SparkSession, data_dir: str) -> DataFrame:
    path = fresh_path(spark, "city-top")
    writers.write_partitioned(_city_top_customers(spark, data_dir), path, "city")
    return spark.read.parquet(path)


def _routed_tables(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rows of the three tables that classified records are routed to."""
    path = fresh_path(spark, "risk-routes")
    writers.route_by_class(orders.classify(load(spark, data_dir, "risk")), path, "risk_level")
    tables = {f"risk_{level}": readers_level for level in ("high", "medium", "low")
              for readers_level in [writers.read_class(spark, path, "risk_level", level)]}
    return source_counts(tables)


def _dead_letter(spark: SparkSession, data_dir: str) -> DataFrame:
    path = fresh_path(spark, "dead-letters")
    writers.write_dead_letters(_validate_events(load(spark, data_dir, "social")), path)
    kept = schemas.table(
        event_id="string", event_type="string", user_id="string", post_id="string", validation_errors="string"
    )
    return readers.read_json_lines(spark, path, kept).select(*kept.fieldNames())


def _flatten_json_users(spark: SparkSession, data_dir: str) -> DataFrame:
    """Customers as nested user records, flattened again."""
    people = load(spark, data_dir, "city_customers")
    nested = people.select(F.to_json(F.struct(
        F.col("customer_id").alias("id"),
        "name",
        F.concat("name", F.lit("@example.com")).alias("email"),
        F.struct("city").alias("address"),
        F.struct(F.concat(F.lit("Company "), F.col("customer_id") % 10).alias("name")).alias("company"),
    )).alias("value"))
    return messages.flatten_users(nested, schemas.API_USER)


def _risk_classify_sql(spark: SparkSession, data_dir: str) -> DataFrame:
    udfs.register(spark)
    return spark.sql(
        "SELECT id, classify_risk(amount, credit_score, failed_attempts) AS risk_level FROM {risk}",
        risk=load(spark, data_dir, "risk"),
    )


def _sentiment_sql(spark: SparkSession, data_dir: str) -> DataFrame:
    udfs.register(spark)
    return spark.sql(
        "SELECT event_id, classify_sentiment(comment_text) AS sentiment FROM {social} WHERE event_type = 'COMMENT'",
        social=load(spark, data_dir, "social"),
    )


def _materialized_mart(spark: SparkSession, data_dir: str) -> DataFrame:
    built = mart.materialize(spark, load(spark, data_dir, "telecom"), fresh_path(spark, "churn-mart"))
    return source_counts({name: built[name] for name, _, _ in mart.MODELS}).select("source", "row_count")


def _refreshed_daily_report(spark: SparkSession, data_dir: str) -> DataFrame:
    """The stored daily report: built from the mornings, then refreshed for the days that went on."""
    txn, path = load(spark, data_dir, "bank_txn"), fresh_path(spark, "daily-report")
    emptied = "day(transaction_date) % 7 = 3"  # these days lose all transactions afterwards
    refresh_daily_report(txn.where(f"hour_of_day < 12 OR {emptied}"), path)
    refresh_daily_report(txn.where(f"NOT ({emptied})"), path, txn.where(f"hour_of_day >= 12 OR {emptied}"))
    return stored_daily_report(spark, path)


# --- streams over the event and order files --------------------------------------------


def stream_table(spark: SparkSession, data_dir: str, base: str, view: str) -> DataFrame:
    """An input table as a stream over the files of its base table, event time as an instant."""
    files = spark.readStream.schema(BASE_TABLES[base]).parquet(f"{data_dir}/{base}.parque[t]")
    text = INPUTS[view].replace("<array>", "array")
    return spark.sql(text, **{base: files}).withColumn("ts", F.col("ts").cast("timestamp"))


def run_stream(spark: SparkSession, stream: DataFrame, make_sink, mode: str) -> DataFrame:
    """Work off a stream into a fresh log and return the log."""
    path = fresh_path(spark, "stream")
    query = jobs.start(stream, make_sink(f"{path}/log"), f"{path}/checkpoint", mode=mode)
    query.awaitTermination()
    return updates.read_log(spark, f"{path}/log")


def _stream_page_views(spark: SparkSession, data_dir: str) -> DataFrame:
    stream = jobs.page_views(stream_table(spark, data_dir, "events", "page_view"), "60 days")
    log = run_stream(spark, stream, updates.log_updates, "update")
    newest = updates.current(log, ["window_start", "page"])
    return ntz(newest.select("window_start", "window_end", "page", "views"))


def _stream_sensor_windows(spark: SparkSession, data_dir: str) -> DataFrame:
    stream = jobs.sensor_windows(stream_table(spark, data_dir, "events", "sensor"), "60 days")
    log = run_stream(spark, stream, sinks.sensor_versions, "update")
    newest = updates.current(log, ["window_start", "sensor_id"])
    return ntz(newest.select(
        "window_start", "window_end", "sensor_id", tidy(F.col("avg_temp"), 6).alias("avg_temp"), "reading_count"
    ))


def _stream_trending(spark: SparkSession, data_dir: str) -> DataFrame:
    stream = jobs.trending(stream_table(spark, data_dir, "events", "social"), "60 days")
    log = run_stream(spark, stream, sinks.trends, "update")
    newest = updates.current(log, ["window_size", "window_start", "hashtag"])
    return ntz(newest.select("hashtag", "window_size", "window_start", "window_end", "mention_count"))


def _stream_viral(spark: SparkSession, data_dir: str) -> DataFrame:
    stream = jobs.likes(stream_table(spark, data_dir, "events", "social"), "60 days")
    log = run_stream(spark, stream, lambda path: sinks.keep_viral(path, 2), "update")
    newest = updates.current(log, ["window_start", "post_id"])
    return ntz(newest.select("post_id", "window_start", "window_end", "like_count"))


def _stream_ranking(spark: SparkSession, data_dir: str) -> DataFrame:
    stream = jobs.engagement(stream_table(spark, data_dir, "events", "social"))
    path = fresh_path(spark, "ranking")
    jobs.start(stream, sinks.rank_users(path), f"{path}-checkpoint", mode="complete").awaitTermination()
    return versions.read(spark, path).drop("calculated_at")


def _stream_landing(spark: SparkSession, data_dir: str) -> DataFrame:
    ingested_at = F.lit(INGESTED_AT).cast("timestamp")
    stream = jobs.landing(stream_table(spark, data_dir, "events", "social"), ingested_at)
    log = run_stream(spark, stream, lambda path: sinks.land(path, f"{path}-dead"), "append")
    return ntz(log.drop("batch_id"))


def _stream_enriched(spark: SparkSession, data_dir: str) -> DataFrame:
    def make_sink(path: str) -> sinks.Sink:
        return sinks.enrich(
            path, lambda: load(spark, data_dir, "user_dim"), lambda: load(spark, data_dir, "post_dim"),
            F.lit(INGESTED_AT).cast("timestamp"),
        )

    log = run_stream(spark, stream_table(spark, data_dir, "events", "social"), make_sink, "append")
    return ntz(log.drop("batch_id"))


def _stream_sentiment(spark: SparkSession, data_dir: str) -> DataFrame:
    stream = jobs.sentiments(stream_table(spark, data_dir, "events", "social"))
    return ntz(run_stream(spark, stream, sinks.sentiments, "append").drop("batch_id", "processed_at"))


# --- replays: the rows of a table arrive in several deliveries, some of them late -------

DELIVERIES = 7
#: Days since the first event, five to a delivery; a tenth of the readings comes one delivery later, another twentieth two later.
ARRIVAL = """least(6, datediff(to_date(ts), DATE'2024-01-01') div 5
  + CASE WHEN reading_id % 20 = 7 THEN 2 WHEN reading_id % 10 = 3 THEN 1 ELSE 0 END)"""
LATEST = "6 days"


def replay(spark: SparkSession, rows: DataFrame, delivery: Column, deliveries: int, start_job) -> None:
    """Put ``rows`` into a folder delivery by delivery, and let a streaming job work off the folder after each.

    ``start_job(stream)`` starts the job, always with the same checkpoint: every delivery is a micro-batch of its own, and the job is stopped and
    taken up again between them.
    """
    path = fresh_path(spark, "replay")
    rows.withColumn("__delivery", delivery).write.partitionBy("__delivery").parquet(f"{path}/staged")
    staged = spark.read.schema(StructType([*rows.schema.fields, StructField("__delivery", IntegerType())])).parquet(f"{path}/staged")
    for number in range(deliveries):
        staged.where(F.col("__delivery") == number).drop("__delivery").write.mode("append").parquet(f"{path}/in")
        start_job(spark.readStream.schema(rows.schema).parquet(f"{path}/in")).awaitTermination()


def _sensor_replay(spark: SparkSession, data_dir: str, start_job) -> None:
    rows = load(spark, data_dir, "sensor").withColumn("ts", F.col("ts").cast("timestamp"))
    replay(spark, rows, F.expr(ARRIVAL).cast("int"), DELIVERIES, start_job)


def _replayed_windows(spark: SparkSession, data_dir: str) -> UpsertStore:
    """Hourly averages per sensor over late deliveries: rows of closed windows are dropped, open windows corrected."""
    path = fresh_path(spark, "windows")
    store = UpsertStore(f"{path}/store", ["window_start", "window_end", "sensor_id"], fold_every=4)
    _sensor_replay(spark, data_dir, lambda stream: jobs.start(
        jobs.sensor_windows(stream, LATEST, "1 hour"), store.sink(), f"{path}/checkpoint", mode="update"))
    return store


WINDOW = ("window_start", "window_end", "sensor_id")


def _stream_late_readings(spark: SparkSession, data_dir: str) -> DataFrame:
    newest = _replayed_windows(spark, data_dir).current(spark)
    return ntz(newest.select(*WINDOW, tidy(F.col("avg_temp"), 6).alias("avg_temp"), "reading_count", "version"))


def _stream_window_history(spark: SparkSession, data_dir: str) -> DataFrame:
    written = _replayed_windows(spark, data_dir).history(spark)
    return ntz(written.select(*WINDOW, tidy(F.col("avg_temp"), 6).alias("avg_temp"), "reading_count", "version", "is_correction"))


def _stream_closed_windows(spark: SparkSession, data_dir: str) -> DataFrame:
    """Windows that the watermark has passed, each once."""
    path = fresh_path(spark, "closed")
    _sensor_replay(spark, data_dir, lambda stream: jobs.start(
        jobs.sensor_windows(stream, LATEST, "1 hour"), updates.log_updates(f"{path}/log"), f"{path}/checkpoint"))
    closed = updates.read_log(spark, f"{path}/log")
    return ntz(closed.select(*WINDOW, tidy(F.col("avg_temp"), 6).alias("avg_temp"), "reading_count"))


def _stream_sensor_alerts(spark: SparkSession, data_dir: str) -> DataFrame:
    path = fresh_path(spark, "alerts")
    _sensor_replay(spark, data_dir, lambda stream: jobs.start(
        state.sensor_alerts(stream, slot="30 minutes", slots=96, delay=LATEST), sinks.alerts(f"{path}/log"), f"{path}/checkpoint"))
    return ntz(updates.read_log(spark, f"{path}/log").drop("batch_id", "detected_at"))


def _stream_running_totals(spark: SparkSession, data_dir: str) -> DataFrame:
    """Transactions as messages of a topic keyed by customer, in seven deliveries."""
    path = fresh_path(spark, "totals")
    rows = load(spark, data_dir, "user_txn").withColumns({
        "message_partition": F.pmod(F.xxhash64("customer_id"), F.lit(4)).cast("int"), "message_offset": F.col("transaction_id")})
    last = rows.agg(F.max("transaction_id")).scalar()
    delivery = F.floor(F.col("transaction_id") * DELIVERIES / (last + 1)).cast("int")
    arrival = ["message_partition", "message_offset"]
    replay(spark, rows, delivery, DELIVERIES, lambda stream: jobs.start(
        state.running_totals(jobs.high_value(stream, arrival=arrival), arrival), updates.log_updates(f"{path}/log"), f"{path}/checkpoint"))
    return updates.read_log(spark, f"{path}/log").drop("batch_id").withColumn("customer_id", F.col("customer_id").cast("bigint"))


def _reloaded_table(spark: SparkSession, data_dir: str) -> DataFrame:
    """The user dimension, loaded once without some users and then anew."""
    users, path = load(spark, data_dir, "user_dim"), fresh_path(spark, "user-dim")
    writers.reload_table(users.where("user_id NOT LIKE '%1'"), path)
    writers.reload_table(users, path)
    return versions.read(spark, path)


def _appended_table(spark: SparkSession, data_dir: str) -> DataFrame:
    """Risk records appended in three batches, two of them delivered twice."""
    risk, path = load(spark, data_dir, "risk"), fresh_path(spark, "risk-table")
    for batch in (0, 1, 1, 2, 0):
        writers.append_checked(spark, risk.where(F.col("id") % 3 == batch), path, batch)
    return spark.read.parquet(path)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {build.__name__: over("bank_txn", build) for build in FRAUD}
    found |= {build.__name__: over("telecom", build) for build in CHURN}
    found |= {name: _model(name) for name in MART}
    found |= {
        "churn_loss_total": _churn_loss_total,
        "data_tests": _data_tests,
        "source_counts": _source_counts,
        "city_top_customers": _city_top_customers,
        "risk_classify": over("risk", orders.risk_classify),
        "risk_route_counts": over("risk", orders.risk_route_counts),
        "merge_records": over("user_txn", _merge_records),
        "validate_events": over("social", _validate_events),
        "raw_events": over("social", _raw_events),
        "enrich_events": _enrich_events,
        "comment_sentiment": over("social", social.comment_sentiment),
        "event_breakdown": over("social", social.event_breakdown),
        "landing_kpis": over("social", lambda events: social.landing_kpis(_raw_events(events))),
        "sentiment_share": over("social", social.sentiment_share),
        "top_hashtags": over("social", lambda events: social.top_hashtags(events, "1 day")),
        "trending_hashtags": over("social", social.trending_rollup),
        "sliding_hashtags": over("social", social.sliding_hashtags),
        "viral_posts": over("social", lambda events: social.viral_posts(events, 2)),
        "influencer_ranking": over("social", social.influencer_ranking),
        "page_view_windows": over("page_view", sensors.page_view_windows),
        "sensor_windows": over("sensor", _sensor_windows),
        "window_versions": over("sensor", _window_versions),
        "sensor_anomalies": over("sensor", lambda readings: sensors.sensor_anomalies(readings, 6 * 3600)),
        "high_value_running_totals": over("user_txn", sensors.high_value_running_totals),
        "csv_load": _csv_load,
        "csv_load_lines": _csv_load_lines,
        "csv_rejects": _csv_rejects,
        "json_scan": _json_scan,
        "decode_events": _decode_events,
        "keyed_messages": _keyed_messages,
        "partitioned_write": _partitioned_write,
        "routed_tables": _routed_tables,
        "dead_letter": _dead_letter,
        "flatten_json_users": _flatten_json_users,
        "risk_classify_sql": _risk_classify_sql,
        "sentiment_sql": _sentiment_sql,
        "materialized_mart": _materialized_mart,
        "refreshed_daily_report": _refreshed_daily_report,
        "stream_page_views": _stream_page_views,
        "stream_sensor_windows": _stream_sensor_windows,
        "stream_trending": _stream_trending,
        "stream_viral": _stream_viral,
        "stream_ranking": _stream_ranking,
        "stream_landing": _stream_landing,
        "stream_enriched": _stream_enriched,
        "stream_sentiment": _stream_sentiment,
        "stream_running_totals": _stream_running_totals,
        "stream_late_readings": _stream_late_readings,
        "stream_window_history": _stream_window_history,
        "stream_closed_windows": _stream_closed_windows,
        "stream_sensor_alerts": _stream_sensor_alerts,
        "reloaded_table": _reloaded_table,
        "appended_table": _appended_table,
    }
    return found
