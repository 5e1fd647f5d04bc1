import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from blotter.operators.windows import sliding_counts
from blotter.streaming import panes as PN
from blotter.streaming import pipeline as SP

T0 = dt.datetime(2024, 3, 1)
WINDOW, SLIDE, DELAY = "5 hours", "2 hours", "12 hours"


def _events(spark, rows):
    return spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m), d) for i, m, d in rows], "id long, ts timestamp_ntz, district string")


def _run(spark, scratch, events, arrival):
    sink = PN.window_sink(f"{scratch}/panes", WINDOW, SLIDE, DELAY, SP.batch_sink(f"{scratch}/windows"))
    for n in range(1 + max(arrival.values())):
        ids = [i for i, a in arrival.items() if a == n]
        events.filter(F.col("id").isin(ids)).coalesce(1).write.mode("append").parquet(f"{scratch}/src")
        stream = spark.readStream.schema(events.schema).parquet(f"{scratch}/src")
        SP.run_available_now(PN.pane_stream(stream, WINDOW, SLIDE, DELAY), sink, f"{scratch}/ckpt", "update")
    seen = spark.read.parquet(f"{scratch}/windows").groupBy("window_start", "window_end", "district").agg(F.max("event_count").alias("n"))
    return {tuple(r) for r in seen.select("window_start", "window_end", "district", "n").collect()}


def _batch(events):
    return {tuple(r) for r in sliding_counts(events, WINDOW, SLIDE).select("window_start", "window_end", "district", "event_count").collect()}


def test_late_rows_within_the_watermark_reach_windows_already_given(spark, scratch):
    rng = random.Random(5)
    rows = [(i, rng.randrange(4000), rng.choice("aab")) for i in range(300)]
    events = _events(spark, rows)
    arrival = {i: min(3, max(0, (m + rng.randrange(-300, 300)) // 1000)) for i, m, _ in rows}
    assert _run(spark, scratch, events, arrival) == _batch(events)


def test_an_arrival_far_ahead_keeps_what_its_late_rows_need(spark, scratch):
    rows = [(0, 10, "a"), (1, 70, "a"), (2, 130, "a"), (3, 200_000, "a")]
    events = _events(spark, rows)
    assert _run(spark, scratch, events, {0: 0, 1: 0, 2: 1, 3: 1}) == _batch(events)


def test_replayed_batch_replaces_its_output_and_a_missing_version_raises(spark, scratch):
    sink = PN.window_sink(f"{scratch}/panes", WINDOW, SLIDE, DELAY, SP.batch_sink(f"{scratch}/windows"))
    pane = lambda h, n: spark.createDataFrame([(T0 + dt.timedelta(hours=h), "a", n)], PN.PANE_SCHEMA)
    sink(pane(0, 3), 0)
    for _ in range(2):
        sink(pane(1, 4), 1)
    got = spark.read.parquet(f"{scratch}/windows").filter("batch_id = 1")
    assert {(r.window_start.hour, r.event_count) for r in got.collect() if r.window_start >= T0} == {(0, 7)}
    assert got.count() == got.dropDuplicates(["window_start", "district"]).count() == 2
    with pytest.raises(RuntimeError):
        sink(pane(2, 1), 5)


def test_nothing_changed_gives_no_windows(spark, scratch):
    sink = PN.window_sink(f"{scratch}/panes", WINDOW, SLIDE, DELAY, SP.batch_sink(f"{scratch}/windows"))
    sink(spark.createDataFrame([], PN.PANE_SCHEMA), 0)
    assert spark.read.schema("event_count long").parquet(f"{scratch}/windows").count() == 0


def test_events_are_not_expanded_into_windows(spark, scratch):
    _events(spark, [(0, 1, "a")]).write.parquet(f"{scratch}/src")
    stream = spark.readStream.schema("id long, ts timestamp_ntz, district string").parquet(f"{scratch}/src")
    plans = [PN.pane_stream(stream, WINDOW, SLIDE, DELAY), SP.sliding_window_stream(stream, WINDOW, SLIDE, DELAY)]
    assert ["Expand" in p._jdf.queryExecution().analyzed().toString() for p in plans] == [False, True]
