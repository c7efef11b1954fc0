"""Readers and writers: bad rows, null markers, repeats."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.checks import require_rows, run_table_tests
from tallyforge.operators.profile import column_roles, duplicate_rows
from tallyforge.plans import mart
from tallyforge.plans.fraud import daily_fraud_report
from tallyforge.plans.stored import create_high_risk_view, refresh_daily_report
from tallyforge.sources import messages, readers, schemas, updates, versions, writers


def write(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


def test_csv_skips_bad_rows_and_reads_null_markers(spark, folder):
    path = write(folder, "t.csv", [
        "transaction_id,customer_id,amount,merchant,category,status",
        'T1,C1,250.00,"Smith, Sons",retail,OK',
        "T2,NULL,1.5,,null,OK",
        "T3,C3,not a number,M,c,OK",   # does not cast
        "T4,C4,1.0,M",                 # too few fields
        "T5,C5,1.0,M,c,OK,extra",      # too many fields
    ])
    loaded = readers.read_csv(spark, path, schemas.CSV_TRANSACTION)
    rows = {r.transaction_id: r for r in loaded.collect()}
    assert set(rows) == {"T1", "T2"}
    assert rows["T1"].merchant == "Smith, Sons" and rows["T1"].amount == 250.0
    assert rows["T2"].customer_id is None and rows["T2"].merchant is None and rows["T2"].category is None
    assert loaded.select("transaction_id").count() == 2  # also when few columns are read


def test_bank_csv_types(spark, folder):
    names = schemas.BANK_TRANSACTION.fieldNames()
    row = {n: "1" for n in names} | {"transaction_date": "2024-03-01", "transaction_time": "10:11:12", "fraud_type": ""}
    path = write(folder, "b.csv", [",".join(names), ",".join(row[n] for n in names)])
    loaded = readers.read_csv(spark, path, schemas.BANK_TRANSACTION)
    assert loaded.schema == schemas.BANK_TRANSACTION
    first = loaded.first()
    assert str(first.transaction_date) == "2024-03-01" and first.transaction_time == "10:11:12"
    assert first.fraud_type is None and first.is_fraud == 1


def test_csv_quoting(spark, folder):
    lines = ["id,text,n", '1,"say ""hi"", ok",2', '2,"ends with \\",3', "3,plain,4", '4,"one"', '5,"a, b",x']
    schema = schemas.table(id="int", text="string", n="int")
    path = write(folder, "q.csv", lines)
    rows = {r.id: (r.text, r.n) for r in readers.read_csv(spark, path, schema).collect()}
    assert rows == {1: ('say "hi", ok', 2), 2: ("ends with \\", 3), 3: ("plain", 4)}
    assert sorted(r.id for r in readers.csv_rejects(spark, path, schema).collect()) == ["4", "5"]
    path = write(folder, "m.csv", ["id,text,n", '1,"two', 'lines",2', "2,plain,3"])
    rows = {r.id: r.text for r in readers.read_csv(spark, path, schema, multi_line=True).collect()}
    assert rows == {1: "two\nlines", 2: "plain"}


def test_decode_keeps_what_the_broker_knows(spark):
    frame = spark.createDataFrame(
        [(b"k", b'{"event_id": "1"}', 2, 7)], "key binary, value binary, partition int, offset long")
    row = messages.decode_events(frame, schemas.SOCIAL_EVENT).first()
    assert (bytes(row.message_key), row.message_partition, row.message_offset) == (b"k", 2, 7)


def test_decode_keeps_unknown_fields_and_survives_bad_json(spark):
    good = json.dumps({"event_id": "1", "hashtags": ["#a"], "watch_time_sec": 67.3, "timestamp": "2026-06-17T10:00:00",
                       "later": 1})
    frame = spark.createDataFrame([(good.encode(),), (b"{broken",), (b'{"timestamp": "soon"}',)], "value binary")
    rows = messages.decode_events(frame, schemas.SOCIAL_EVENT, time_column="timestamp").collect()
    assert rows[0].raw_payload == good and rows[0].watch_time_sec == 67.3 and rows[0].hashtags == ["#a"]
    assert str(rows[0].ts) == "2026-06-17 10:00:00"
    assert rows[1].event_id is None and rows[1].raw_payload == "{broken"
    assert rows[2].ts is None


def test_flatten_users(spark):
    user = {"id": 1, "name": "Ann", "email": "a@x", "address": {"city": "Rome", "zip": "1"}, "company": {"name": "Co"}}
    frame = spark.createDataFrame([(json.dumps(user),)], "value string")
    assert messages.flatten_users(frame, schemas.API_USER).first().asDict() == {
        "id": 1, "name": "Ann", "email": "a@x", "city": "Rome", "company": "Co"
    }


def test_merge_records_in_order(spark):
    frame = spark.range(25).withColumn("v", F.col("id") * 2).orderBy(F.rand(1))
    rows = {r.batch_no: r for r in messages.merge_records(frame, "id", size=10, blocks=4).collect()}
    assert {b: (r.record_count, r.first_record, r.last_record) for b, r in rows.items()} == {
        0: (10, 0, 9), 1: (10, 10, 19), 2: (5, 20, 24)
    }
    assert json.loads(rows[2].records) == [{"id": i, "v": 2 * i} for i in range(20, 25)]


def test_append_needs_the_same_columns(spark, folder):
    path = f"{folder}/users"
    writers.append_checked(spark, spark.range(2), path, 0)
    for _ in range(2):  # a retried batch replaces itself
        writers.append_checked(spark, spark.range(3), path, 1)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError):
        writers.append_checked(spark, spark.range(1).withColumnRenamed("id", "other"), path, 2)


def test_repeated_writes_replace_themselves(spark, folder):
    frame = spark.createDataFrame([(1, "high"), (2, "low")], "id int, level string")
    for _ in range(2):
        writers.route_by_class(frame, f"{folder}/routes", "level")
        writers.write_batch(frame, f"{folder}/log", 3)
    assert sorted(os.listdir(f"{folder}/routes"))[-2:] == ["level=high", "level=low"]
    assert [r.id for r in writers.read_class(spark, f"{folder}/routes", "level", "low").collect()] == [2]
    log = spark.read.parquet(f"{folder}/log")
    assert log.count() == 2 and log.columns == ["id", "level", "batch_id"]


def test_update_log_views(spark, folder):
    for batch, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("a", 5), ("c", 1)]]):
        writers.write_batch(spark.createDataFrame(rows, "k string, n int"), f"{folder}/log", batch)
    log = updates.read_log(spark, f"{folder}/log")
    newest = {r.k: (r.n, r.version) for r in updates.current(log, ["k"]).collect()}
    assert newest == {"a": (5, 3), "b": (1, 1), "c": (1, 1)}
    versions = sorted((r.k, r.n, r.version, r.is_correction) for r in updates.history(log, ["k"]).collect())
    assert versions == [("a", 1, 1, False), ("a", 2, 2, True), ("a", 5, 3, True), ("b", 1, 1, False), ("c", 1, 1, False)]
    assert {r.k for r in updates.latest_batch(log).collect()} == {"a", "c"}
    updates.compact(spark, f"{folder}/log", f"{folder}/table", ["k"])
    assert spark.read.parquet(f"{folder}/table").count() == 3


def test_refresh_changes_only_the_changed_days(spark, folder):
    def txns(rows):
        return spark.createDataFrame(rows, "d string, is_fraud int, transaction_amount double").withColumn(
            "transaction_date", F.to_date("d"))

    path, first = f"{folder}/report", [("2024-01-01", 0, 1.0), ("2024-01-02", 1, 2.0)]
    refresh_daily_report(txns(first), path)
    untouched = {f: os.path.getmtime(f"{path}/transaction_date=2024-01-01/{f}")
                 for f in os.listdir(f"{path}/transaction_date=2024-01-01")}
    late = [("2024-01-02", 0, 4.0)]
    refresh_daily_report(txns(first + late), path, txns(late))
    expected = daily_fraud_report(txns(first + late))
    stored = spark.read.parquet(path).select(*expected.columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, expected.collect()))
    assert untouched == {f: os.path.getmtime(f"{path}/transaction_date=2024-01-01/{f}")
                         for f in os.listdir(f"{path}/transaction_date=2024-01-01")}


def test_table_tests_count_failures(spark):
    frame = spark.createDataFrame([(1, "x"), (1, None), (2, "y"), (None, None), (None, "z")], "k int, v string")
    got = {(r.column_name, r.test): r.failures for r in run_table_tests("m", frame, "k", ["k", "v"]).collect()}
    assert got == {("k", "unique"): 1, ("k", "not_null"): 2, ("v", "not_null"): 2}
    empty = run_table_tests("m", frame.where("false"), "k", ["k"]).collect()
    assert [r.failures for r in empty] == [0, 0]


def test_gate(spark):
    require_rows(a=spark.range(1))
    with pytest.raises(ValueError, match="b"):
        require_rows(a=spark.range(1), b=spark.range(0))


def test_roles_and_duplicates(spark):
    frame = spark.createDataFrame([(i, i % 2, float(i % 5), "xyz"[i % 3]) for i in range(30)],
                                  "id int, bit int, num double, txt string")
    assert {r.column_name: r.role for r in column_roles(frame).collect()} == {
        "id": "Identifier", "bit": "Binary", "num": "Numerical", "txt": "Categorical"
    }
    assert duplicate_rows(frame.union(frame.limit(4))).first()[0] == 4
    assert duplicate_rows(frame.where("false")).first()[0] == 0


def test_mart_is_readable_again(spark, folder):
    from tallyforge.plans.inputs import load

    built = mart.materialize(spark, load(spark, "/root/testdata/sf0.001", "telecom"), folder)
    assert sorted(os.listdir(folder)) == sorted(mart.STORED)
    assert spark.table("mart_churn_kpis").count() == built["mart_churn_kpis"].count() == 3


def test_high_risk_view(spark):
    from tallyforge.plans.inputs import load

    create_high_risk_view(load(spark, "/root/testdata/sf0.01", "bank_txn"))
    assert spark.sql("SELECT count(*) FROM vw_high_risk_transactions").first()[0] == 415


def test_reload_replaces_rows(spark, folder):
    for rows in ([("u1",), ("u2",)], [("u3",)]):
        writers.reload_table(spark.createDataFrame(rows, "user_id string"), f"{folder}/dim")
    assert [r.user_id for r in versions.read(spark, f"{folder}/dim").collect()] == ["u3"]
