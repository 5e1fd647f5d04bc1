"""Streaming runs equal their batch forms; restarts and replays do not duplicate alerts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM

from blotter.operators.alerts import alert_records
from blotter.operators.windows import trailing_count
from blotter.sources import testtables as TT
from blotter.streaming import pipeline as SP

ALERT = "district string, timestamp timestamp_ntz, event_count int, threshold int, severity string"


def _rows(df):
    return sorted(tuple(r) for r in df.select("district", "timestamp", "event_count", "severity").collect())


def test_stream_equals_batch_and_restart_is_exact(spark, scratch):
    msgs = TT.message_rows(spark, MEDIUM).filter(F.col("ts") < dt.datetime(2024, 1, 8))
    accepted, _ = SP.validated_stream(msgs)
    batch = alert_records(trailing_count(accepted.select("id", "ts", "district"), 24 * 3600), 10)

    src, out, ckpt = f"{scratch}/src", f"{scratch}/alerts", f"{scratch}/ckpt"
    days = [dt.datetime(2024, 1, d) for d in range(1, 9)]
    schema = "id long, ts timestamp_ntz, value string"

    def run():
        stream = SP.read_messages(spark, src, "parquet", schema=schema, options={"maxFilesPerTrigger": "1"})
        SP.run_available_now(SP.build_alert_stream(stream, 24 * 3600, 10), SP.batch_sink(out), ckpt)

    for a, b in zip(days[:4], days[1:5]):   # first half, then stop
        msgs.filter((F.col("ts") >= a) & (F.col("ts") < b)).coalesce(1).write.mode("append").parquet(src)
    run()
    for a, b in zip(days[4:7], days[5:8]):  # restart from the checkpoint with new files
        msgs.filter((F.col("ts") >= a) & (F.col("ts") < b)).coalesce(1).write.mode("append").parquet(src)
    run()
    run()                                   # nothing new: no extra output
    got = spark.read.parquet(out).drop("query", "batch_id")
    assert _rows(got) == _rows(batch)


def test_rejected_stream_lists_missing_fields(spark, scratch):
    msgs = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), '{"CASE NUMBER":"A","DISTRICT":"","DATE":"x","PRIMARY TYPE":"T"}'),
         (2, dt.datetime(2024, 1, 1), '{bad'),
         (3, dt.datetime(2024, 1, 1), '{"CASE NUMBER":"B","DISTRICT":"4","DATE":"x","PRIMARY TYPE":"T"}')],
        "id long, ts timestamp_ntz, value string")
    acc, rej = SP.validated_stream(msgs)
    assert [r.id for r in acc.collect()] == [3]
    got = {r.id: r.missing for r in rej.collect()}
    assert got == {1: "DISTRICT", 2: "CASE NUMBER,DISTRICT,DATE,PRIMARY TYPE"}


def test_sink_replay_of_a_batch_is_idempotent(spark, scratch):
    df = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), 11, 10, "MEDIUM")],
                               "district string, timestamp timestamp_ntz, event_count int, threshold int, severity string")
    sink = SP.batch_sink(f"{scratch}/a", f"{scratch}/docs")
    sink(df, 7)
    sink(df, 7)
    assert spark.read.parquet(f"{scratch}/a").count() == 1
    assert spark.read.json(f"{scratch}/docs").count() == 1


def test_counters_and_raw_event_sink(spark, scratch):
    msgs = TT.message_rows(spark, "/root/testdata/sf0.001")
    src = f"{scratch}/src"
    msgs.coalesce(1).write.parquet(src)
    schema = "id long, ts timestamp_ntz, value string"
    stream = SP.read_messages(spark, src, "parquet", schema=schema)
    q = SP.run_available_now(SP.build_alert_stream(stream, 24 * 3600, 2), SP.batch_sink(f"{scratch}/out"),
                             f"{scratch}/ckpt")
    seen = [p["observedMetrics"]["stream_counters"] for p in q.recentProgress if p.get("observedMetrics")]
    accepted, _ = SP.validated_stream(msgs)
    assert sum(int(m["processed"]) for m in seen) == accepted.count()
    assert sum(int(m["alerts"]) for m in seen) == spark.read.parquet(f"{scratch}/out").count()
    acc_stream, _ = SP.validated_stream(SP.read_messages(spark, src, "parquet", schema=schema))
    SP.raw_event_sink(acc_stream, f"{scratch}/raw", f"{scratch}/raw-ckpt").awaitTermination()
    assert spark.read.parquet(f"{scratch}/raw").count() == accepted.count()


def test_stream_windows_do_not_depend_on_session_zone(spark, scratch):
    from blotter.operators.windows import sliding_counts
    msgs = TT.message_rows(spark, "/root/testdata/sf0.001")
    accepted, _ = SP.validated_stream(msgs)
    batch = sorted(tuple(r) for r in sliding_counts(accepted, "5 hours", "2 hours").collect())
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        got = SP.stream_window_counts(spark, msgs, "5 hours", "2 hours", "12 hours", chunks=2,
                                      work=f"{scratch}/w")
        got = sorted(tuple(r) for r in got.select("window_start", "window_end", "district",
                                                  "event_count").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == batch


def test_processing_time_clock(spark, scratch):
    msgs = TT.message_rows(spark, "/root/testdata/sf0.001")
    src = f"{scratch}/src"
    msgs.coalesce(1).write.parquet(src)
    stream = SP.read_messages(spark, src, "parquet", schema="id long, ts timestamp_ntz, value string")
    SP.run_available_now(SP.build_alert_stream(stream, 300, 10, clock="processing"),
                         SP.batch_sink(f"{scratch}/out"), f"{scratch}/ckpt")
    out = spark.read.parquet(f"{scratch}/out")
    # one batch, one processing time: each district's k-th event counts k
    accepted, _ = SP.validated_stream(msgs)
    per_district = {r.district: r.n for r in accepted.groupBy("district").count().withColumnRenamed("count", "n").collect()}
    want = sum(max(0, n - 10) for n in per_district.values())
    assert out.count() == want


def test_window_alert_stream_equals_batch(spark, scratch):
    from blotter.operators.alerts import window_alert_records
    from blotter.operators.windows import sliding_counts
    msgs = TT.message_rows(spark, MEDIUM).filter(F.col("ts") < dt.datetime(2024, 1, 6))
    accepted, _ = SP.validated_stream(msgs)
    batch = window_alert_records(sliding_counts(accepted, "24 hours", "6 hours"), 10)
    src = f"{scratch}/src"
    SP.replay(spark, msgs, scratch, 3, lambda m: SP.build_window_alert_stream(m, "24 hours", "6 hours", "48 hours", 10),
              SP.batch_sink(f"{scratch}/out"), output_mode="update")
    got = (spark.read.parquet(f"{scratch}/out")
           .groupBy("district", "window_start", "window_end", "threshold", "severity")
           .agg(F.max("event_count").alias("event_count")))
    final = got.groupBy("district", "window_start", "window_end").agg(F.max("event_count").alias("n"))
    want = {(r.district, r.window_start, r.event_count) for r in batch.collect()}
    assert {(r.district, r.window_start, r.n) for r in final.collect()} == want


def test_table_state_stream_equals_batch_and_replays(spark, scratch):
    msgs = TT.message_rows(spark, MEDIUM).filter(F.col("ts") < dt.datetime(2024, 1, 7))
    accepted, _ = SP.validated_stream(msgs)
    batch = alert_records(trailing_count(accepted.select("id", "ts", "district"), 24 * 3600), 10)
    sink = SP.table_state_alert_sink(f"{scratch}/hist", f"{scratch}/out", 24 * 3600, 10)
    held = []

    def keeping(batch, batch_id):
        held.append((batch_id, batch.collect(), batch.schema))
        sink(batch, batch_id)

    SP.replay(spark, msgs, scratch, 5, SP.accepted_events, keeping)
    got = spark.read.parquet(f"{scratch}/out").drop("query", "batch_id")
    assert _rows(got) == _rows(batch)
    # replay the last micro-batch by hand (as after a failure before its commit)
    last, rows, schema = held[-1]
    version = f"{scratch}/hist/query=alerts/v={last}"
    hist_before = sorted(tuple(r) for r in spark.read.parquet(version).collect())
    sink(spark.createDataFrame(rows, schema), last)
    assert _rows(spark.read.parquet(f"{scratch}/out").drop("query", "batch_id")) == _rows(batch)
    assert sorted(tuple(r) for r in spark.read.parquet(version).collect()) == hist_before
    # only the newest versions are kept, nothing else stays behind, and a missing version is an error
    import os
    assert sorted(os.listdir(f"{scratch}/hist/query=alerts")) == [f"v={last - 2}", f"v={last - 1}", f"v={last}", "work"]
    assert os.listdir(f"{scratch}/hist/query=alerts/work") == []
    with pytest.raises(RuntimeError, match="history version"):
        sink(spark.createDataFrame(rows, schema), last + 5)


def test_new_query_name_leaves_old_alerts_alone(spark, scratch):
    old = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), 11, 10, "MEDIUM")], ALERT)
    new = spark.createDataFrame([("2", dt.datetime(2024, 1, 2), 12, 10, "MEDIUM")], ALERT)
    SP.batch_sink(f"{scratch}/a", query="first")(old, 0)
    SP.batch_sink(f"{scratch}/a", query="second")(new, 0)
    assert {r.district for r in spark.read.parquet(f"{scratch}/a").collect()} == {"1", "2"}


def test_micro_batch_is_computed_once(spark, scratch):
    """Ten upstream rows are read ten times in all, whatever number of sinks writes them."""
    from pyspark.sql.types import StringType
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    udf = F.udf(count, StringType()).asNondeterministic()
    rows = spark.createDataFrame([(i, dt.datetime(2024, 1, 1), "a") for i in range(10)], "id long, ts timestamp_ntz, district string")
    batch = rows.withColumn("district", udf("district"))
    SP.table_state_alert_sink(f"{scratch}/h", f"{scratch}/o", 300, 2, docs_dir=f"{scratch}/d")(batch, 0)
    assert seen.value == 10
    assert spark.read.parquet(f"{scratch}/o").count() == spark.read.json(f"{scratch}/d").count() == 8


def test_arrivals_keep_rows_without_time_and_write_many_files(spark, scratch):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i) if i % 3 else None, "{}") for i in range(30)]
    msgs = spark.createDataFrame(rows, SP.MESSAGE_SCHEMA).repartition(4)
    seen = []
    for _ in SP.arrivals(msgs, f"{scratch}/in", 3):
        seen.append(spark.read.parquet(f"{scratch}/in").count())
    assert seen == sorted(seen) and seen[-1] == 30
    _, rejected = SP.validated_stream(spark.read.schema(SP.MESSAGE_SCHEMA).parquet(f"{scratch}/in"))
    assert {r.id for r in rejected.collect() if "ts" in r.missing.split(",")} == set(range(0, 30, 3))


def test_jdbc_target_deletes_then_appends(spark, monkeypatch):
    """Against a stand-in: no database runs here."""
    from pyspark.sql import DataFrameWriter
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, props: calls.append((url, table, mode, props, self._df.collect())))
    target = SP.jdbc_target("jdbc:x", "alerts", {"user": "u"}, execute=lambda spark, url, props, sql: calls.append((url, props, sql)))
    rows = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), 11, 10, "MEDIUM")], ALERT)
    SP.batch_sink(None, query="it's", jdbc=target)(rows, 4)
    assert calls[0] == ("jdbc:x", {"user": "u"}, "DELETE FROM alerts WHERE query_name = 'it''s' AND batch_id = 4")
    url, table, mode, props, written = calls[1]
    assert (url, table, mode, props) == ("jdbc:x", "alerts", "append", {"user": "u"})
    assert [(r.district, r.query_name, r.batch_id) for r in written] == [("1", "it's", 4)]


def test_broker_rows_map_to_messages(spark):
    rows = [(b"k", b'{"CASE NUMBER":"A","DISTRICT":"3","DATE":"x","PRIMARY TYPE":"T"}', "events", 2, 17,
             dt.datetime(2024, 1, 1, 12, 0, 0))]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, "
                                     "timestamp timestamp")
    m = SP.from_broker_rows(df).collect()[0]
    assert m.id == 17 and m.value.startswith('{"CASE NUMBER"')
    acc, _ = SP.validated_stream(SP.from_broker_rows(df))
    assert [r.district for r in acc.collect()] == ["3"]


def test_publish_messages_matches_events_to_json(spark, scratch):
    from __spark_entry__ import queries
    SP.publish_messages(TT.incidents(spark, "/root/testdata/sf0.001"), f"{scratch}/pub")
    got = sorted(r.value for r in spark.read.text(f"{scratch}/pub").collect())
    want = sorted(r.value for r in queries()["events_to_json"](spark, "/root/testdata/sf0.001").collect())
    assert got == want and len(got) > 0


def test_alert_sink_adds_audit_time(spark, scratch):
    df = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), 11, 10, "MEDIUM")],
                               "district string, timestamp timestamp_ntz, event_count int, threshold int, severity string")
    SP.batch_sink(f"{scratch}/a", mart="alerts")(df, 0)
    got = spark.read.parquet(f"{scratch}/a")
    assert got.columns[:6] == ["district", "timestamp", "event_count", "threshold", "severity", "created_at"]
    assert got.filter("created_at IS NOT NULL").count() == 1


def test_rejected_event_sink(spark, scratch):
    msgs = TT.message_rows(spark, "/root/testdata/sf0.001")
    msgs.coalesce(1).write.parquet(f"{scratch}/src")
    stream = SP.read_messages(spark, f"{scratch}/src", "parquet", schema="id long, ts timestamp_ntz, value string")
    SP.rejected_event_sink(stream, f"{scratch}/dead", f"{scratch}/ck").awaitTermination()
    _, rejected = SP.validated_stream(msgs)
    got = spark.read.parquet(f"{scratch}/dead")
    assert got.count() == rejected.count() > 0
    assert got.filter("missing = ''").count() == 0
