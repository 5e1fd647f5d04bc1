"""Committed stream output: restarts, failures between the sinks, late events, counters, idle stop."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from blotter.operators.alerts import alert_records
from blotter.operators.windows import trailing_count
from blotter.streaming import commits as CM
from blotter.streaming import pipeline as SP

T0 = dt.datetime(2024, 3, 1)
MESSAGE = '{"CASE NUMBER":"C%d","DISTRICT":"%s","DATE":"x","PRIMARY TYPE":"T"}'


@pytest.fixture(scope="module")
def messages(spark):
    rnd = random.Random(4)
    rows = [(i, T0 + dt.timedelta(seconds=30 * i + rnd.randrange(20)), MESSAGE % (i, rnd.choice(["1", "1", "2", ""]))) for i in range(240)]
    return spark.createDataFrame(rows + [(900, T0, "{bad"), (901, None, MESSAGE % (901, "1"))], SP.MESSAGE_SCHEMA)


def batch_form(messages, window, threshold):
    events = SP.accepted_events(messages)
    return sorted(map(tuple, alert_records(trailing_count(events, window), threshold).select(*SP.ALERT_COLUMNS).collect()))


def alerts(spark, base, what="alerts"):
    return sorted(map(tuple, CM.read_committed(spark, base, what).select(*SP.ALERT_COLUMNS).collect()))


def test_restarts_equal_the_batch_form(spark, messages, scratch):
    out = SP.committed_run(spark, messages, 900, 5, chunks=3, work=scratch)
    assert alerts(spark, out) == alerts(spark, out, "docs") == batch_form(messages, 900, 5) != []
    told = CM.stream_counters(spark, out).first()
    valid = SP.accepted_events(messages).count()
    assert tuple(told) == (3, valid, messages.count() - valid, 0, len(alerts(spark, out)))


def test_a_failed_batch_is_unseen_until_it_is_replayed(spark, messages, scratch, monkeypatch):
    """The second arrival fails after its alerts were written: readers see the first only; the restart completes it once."""
    plain, fail = CM.put_path, []

    def put(session, source, target):
        if fail and "manifest" in target:
            raise RuntimeError("lost")
        plain(session, source, target)
    monkeypatch.setattr(CM, "put_path", put)
    first = None
    for k in SP.arrivals(messages, f"{scratch}/source", 2):
        def run():
            stream = SP.read_messages(spark, f"{scratch}/source", "parquet", schema=SP.MESSAGE_SCHEMA)
            SP.run_available_now(CM.judged_messages(stream), CM.committed_alert_sink(f"{scratch}/out", 900, 5), f"{scratch}/checkpoint")
        if k == 1:
            first = alerts(spark, f"{scratch}/out")
            fail.append(1)
            with pytest.raises(Exception, match="lost"):
                run()
            assert spark.read.parquet(f"{scratch}/out/alerts").count() > len(first)  # half done, and there
            assert alerts(spark, f"{scratch}/out") == alerts(spark, f"{scratch}/out", "docs") == first
            fail.clear()
        run()
    assert alerts(spark, f"{scratch}/out") == alerts(spark, f"{scratch}/out", "docs") == batch_form(messages, 900, 5)


def test_replaying_a_committed_batch_replaces_its_attempt(spark, messages, scratch):
    judged = CM.judged_messages(messages)
    for _ in range(2):
        CM.committed_alert_sink(scratch, 900, 5)(judged, 0)
    assert alerts(spark, scratch) == batch_form(messages, 900, 5)
    assert spark.read.parquet(f"{scratch}/alerts").select("attempt").distinct().count() == 1 and CM.read_manifest(spark, scratch).count() == 1


def test_late_and_counted_events_are_the_accepted_ones(spark, messages, scratch):
    out = SP.committed_run(spark, messages, 900, 5, chunks=3, work=scratch, delay_seconds=1800, by=(F.col("id") % 3).cast("int"))
    late = CM.read_committed(spark, out, "late")
    events = [(r.id, r.ts) for r in SP.accepted_events(messages).collect()]
    mark, want = None, set()
    for k in range(3):
        here = [(i, t) for i, t in events if i % 3 == k]
        want |= {i for i, t in here if mark and t < mark}
        mark = max([t - dt.timedelta(seconds=1800) for _, t in here] + ([mark] if mark else []))
    assert {r.id for r in late.collect()} == want != set() and late.count() == len(want)
    told = CM.stream_counters(spark, out).first()
    assert told.processed + told.late == len(events) and told.late == len(want)


def test_a_missing_watermark_is_an_error_and_nothing_committed_is_empty(spark, messages, scratch):
    with pytest.raises(RuntimeError, match="watermark"):
        CM.committed_alert_sink(scratch, 900, 5, delay_seconds=60)(CM.judged_messages(messages), 3)
    assert CM.read_committed(spark, f"{scratch}/none").count() == 0 and CM.read_committed(spark, f"{scratch}/none", "late").count() == 0
    assert tuple(CM.stream_counters(spark, f"{scratch}/none").first()) == (0, 0, 0, 0, 0)


def test_an_empty_batch_keeps_the_watermark(spark, messages, scratch):
    judged = CM.judged_messages(messages)
    for n, rows in enumerate([judged, judged.limit(0), judged.where("id < 5")]):
        CM.committed_alert_sink(scratch, 900, 5, delay_seconds=60)(rows, n)
    told = {r.batch_id: (r.processed, r.late) for r in CM.read_manifest(spark, scratch).collect()}
    assert told[1] == (0, 0) and told[2][0] == 0 and told[2][1] > 0


def test_idle_stop(spark, messages, scratch):
    got = SP.stream_idle_stop(spark, messages, chunks=3, idle_seconds=1.5, work=scratch)
    assert sorted(r.id for r in got.select("id").collect()) == sorted(r.id for r in SP.accepted_events(messages).select("id").collect())
    assert not any(q.isActive for q in spark.streams.active)


def test_idle_stop_raises_a_failure(spark, messages, scratch):
    messages.write.parquet(f"{scratch}/source")

    def broken(batch, n):
        raise ValueError("broken sink")
    stream = SP.read_messages(spark, f"{scratch}/source", "parquet", schema=SP.MESSAGE_SCHEMA)
    query = stream.writeStream.foreachBatch(broken).option("checkpointLocation", f"{scratch}/ckpt").trigger(processingTime="200 milliseconds").start()
    with pytest.raises(Exception, match="broken sink"):
        SP.until_idle(query, 5)
