"""Exact deduplication as a stream with keyed state that never expires.

Documents get a digest of their normalised text and a number of their own. A stream reads these narrow rows and
keeps, per digest, which row stays (most code points, then smallest id), where its content lies (the row's number in
the written table) and how many rows it has met. The state lives on disk, in RocksDB, so it may exceed memory, and
new documents can be added by running the stream again over the same checkpoint. Whenever a digest was met twice,
the texts themselves are compared byte for byte; rows that share a digest but not the text form groups of their own.

Edge cases: a null text counts as empty and equals all texts without a character that is not white space; a null
id loses against any other; of rows alike in length and id the one read first stays; an empty table gives an empty
result; other columns are kept by ``kept_rows`` and ignored by ``groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import SPACE, UID, text_of, utf8, with_uid, written
from tallyforge.session import fresh_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Bytes of narrow rows that one micro-batch takes in; about 10**8 documents.
BATCH_BYTES = 8 << 30
#: Rows of a group that meet its staying row in one task.
COMPARED_TOGETHER = 2000


def normalised(column: str = "text") -> Column:
    """The text without white space."""
    text = text_of(column)
    for character in SPACE:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def sha256(text: Column) -> Column:
    return F.sha2(utf8(text), 256)


def fingerprinted(docs: DataFrame, digest=sha256) -> DataFrame:
    """``docs`` with row number, digest and length, written once: the table that locators point into."""
    return written(with_uid(docs).withColumns({
        "__llm_digest": digest(normalised()),
        "__llm_points": F.length(text_of()).cast("bigint"),
    }), "dedup-rows")


def remember(spark: SparkSession, path: str, doc_type: str, checkpoint: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Take the fingerprints under ``path`` into the state at ``checkpoint``; the state as a table, a row per digest.

    Columns: digest, n (rows met), keep_id, keep_uid (the content locator).
    """
    session = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # a store per partition, most of them small: no room reserved ahead for their logs
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    rows = (
        session.readStream.schema(f"doc_id {doc_type}, __llm_digest string, __llm_points bigint, {UID} bigint")
        .option("maxBytesPerTrigger", batch_bytes).parquet(path)
    )
    best = F.struct(-F.col("__llm_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col(UID))
    state = rows.groupBy("__llm_digest").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n"))
    query = (
        state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).start()
    )
    query.awaitTermination()
    table = spark.read.format("statestore").load(checkpoint).select("key.*", "value.*").toDF("digest", "best", "n")
    return table.select("digest", "n", F.col("best")["doc_id"].alias("keep_id"), F.col("best")[UID].alias("keep_uid"))


def unequal(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows (number, digest, id, length, normalised text) that share a digest with a text that is not theirs."""
    met = state.where("n > 1")
    # Spark splits a digest that holds many rows; written, so that both sides below share the one shuffle of texts
    hits = written(rows.select(UID, F.col("__llm_digest").alias("digest"), "doc_id", "__llm_points", normalised().alias("body")).join(
        met, "digest"), "dedup-hits")
    # a large group is dealt to several tasks, each with a copy of the staying text
    tasks = (F.floor(F.col("n") / COMPARED_TOGETHER) + 1).cast("int")
    members = hits.where(F.col(UID) != F.col("keep_uid")).withColumn("deal", F.pmod(F.xxhash64(UID), tasks).cast("int"))
    stays = hits.where(F.col(UID) == F.col("keep_uid")).select(
        "digest", F.col("body").alias("kept_body"), F.explode(F.sequence(F.lit(0), tasks - 1)).alias("deal"))
    return members.join(stays, ["digest", "deal"]).where("body <> kept_body").select(
        UID, "digest", "doc_id", "__llm_points", "body")


def resolved(docs: DataFrame, digest=sha256, batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, DataFrame]:
    """The written rows, and per row number: keep_id, keep_uid, group_size."""
    rows = fingerprinted(docs, digest)
    spark, path = docs.sparkSession, rows.inputFiles()[0].rsplit("/", 1)[0] if not rows.isEmpty() else None
    if path is None:
        return rows, rows.select(UID, F.col("doc_id").alias("keep_id"), F.col(UID).alias("keep_uid"), F.lit(0).cast("bigint").alias("group_size"))
    state = remember(spark, path, dict(rows.dtypes)["doc_id"], fresh_path(spark, "dedup-state"), batch_bytes)
    others = written(unequal(rows, state), "dedup-unequal")
    narrow = rows.select(UID, F.col("__llm_digest").alias("digest"))
    if others.isEmpty():
        return rows, narrow.join(state, "digest").select(UID, "keep_id", "keep_uid", F.col("n").alias("group_size"))
    # digests that met: the texts decide, compared as a whole
    best = F.struct(-F.col("__llm_points"), F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col(UID).alias("uid"))
    regrouped = others.groupBy("digest", "body").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size"))
    own = others.join(regrouped, ["digest", "body"]).select(
        UID, F.col("best")["id"].alias("keep_id"), F.col("best")["uid"].alias("keep_uid"), "group_size")
    left = others.groupBy("digest").agg(F.count(F.lit(1)).alias("n_others"))
    rest = narrow.join(others.select(UID), UID, "left_anti").join(state, "digest").join(left, "digest", "left").select(
        UID, "keep_id", "keep_uid", (F.col("n") - F.coalesce("n_others", F.lit(0))).alias("group_size"))
    return rows, rest.unionByName(own)


def groups(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, found = resolved(docs.select("doc_id", "text"), **options)
    shown = F.col("__llm_digest") if "digest" not in options else sha256(normalised())
    return rows.select(UID, "doc_id", shown.alias("text_sha256")).join(found, UID).select(
        "doc_id", "keep_id", "group_size", (F.col(UID) == F.col("keep_uid")).alias("kept"), "text_sha256")


def kept_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    rows, found = resolved(docs, **options)
    stays = found.where(F.col(UID) == F.col("keep_uid")).select(UID)
    return rows.join(stays, UID, "left_semi").select(*docs.columns)
