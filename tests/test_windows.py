"""Trailing and sliding window counts, thresholds and severities."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from blotter.operators.alerts import alert_records
from blotter.operators.windows import sliding_counts, trailing_count

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _events(spark, rows):
    return spark.createDataFrame(rows, "id long, district string, ts timestamp_ntz")


def test_window_edge_keeps_row_exactly_w_old(spark):
    rows = [(1, "a", T0), (2, "a", T0), (3, "a", T0 + dt.timedelta(minutes=5)),
            (4, "a", T0 + dt.timedelta(minutes=5, seconds=1))]
    out = trailing_count(_events(spark, rows), 300).orderBy("id").collect()
    assert [r.event_count for r in out] == [1, 2, 3, 2]


def brute(rows, w):
    out = {}
    for i, d, t in rows:
        out[i] = sum(1 for j, d2, t2 in rows
                     if d2 == d and t - dt.timedelta(seconds=w) <= t2 <= t and (t2 < t or j <= i))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_trailing_count_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        t = T0 + dt.timedelta(seconds=rnd.randrange(0, 6 * 3600) // 30 * 30)  # many ties
        rows.append((i, rnd.choice(["a", "b", None]), t))
    got = {r.id: r.event_count for r in trailing_count(_events(spark, rows).repartition(3), 1800).collect()}
    assert got == brute(rows, 1800)


def test_one_key_in_one_instant(spark):
    rows = [(i, "hot", T0 + dt.timedelta(seconds=i % 50)) for i in range(300)]   # all inside one window
    got = {r.id: r.event_count for r in trailing_count(_events(spark, rows), 3600).collect()}
    assert got == brute(rows, 3600)


def test_repeated_and_null_ids_and_null_times(spark):
    """Repeated ids are separate events, NULL ids come first among ties, NULL times count nowhere."""
    at = [T0 + dt.timedelta(minutes=m) for m in range(4)]
    rows = [(1, "a", at[0]), (1, "a", at[0]), (2, "a", at[1]), (None, "a", at[1]), (None, "a", None), (3, "a", None), (4, None, at[1]), (4, None, at[2]), (5, "a", at[3])]
    df = _events(spark, rows).withColumn("n", F.monotonically_increasing_id())
    got = sorted((repr(r.id), repr(r.district), repr(r.ts), r.event_count) for r in trailing_count(df, 120).collect())
    want = [(1, "a", at[0], 1), (1, "a", at[0], 2), (None, "a", at[1], 3), (2, "a", at[1], 4), (None, "a", None, None), (3, "a", None, None), (4, None, at[1], 1),
            (4, None, at[2], 2), (5, "a", at[3], 3)]
    assert got == sorted((repr(i), repr(d), repr(t), c) for i, d, t, c in want)
    assert trailing_count(df.limit(0), 120).count() == 0


def test_a_key_with_all_rows_is_spread_evenly(spark, scratch):
    df = spark.range(40_000).select("id", F.lit("hot").alias("district"), F.lit(T0).cast("timestamp_ntz").alias("ts"))
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert trailing_count(df, 600, work=f"{scratch}/work").agg(F.max("event_count")).first()[0] == 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    sizes = [r["count"] for r in spark.read.parquet(f"{scratch}/work").groupBy("__p").count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 2 * 80_000 / len(sizes)


def test_severity_boundaries(spark):
    counts = spark.createDataFrame([(i, "d", T0, c) for i, c in enumerate([10, 11, 20, 21])],
                                   "id long, district string, ts timestamp_ntz, event_count long")
    out = {r.event_count: r.severity for r in alert_records(counts, 10).collect()}
    assert out == {11: "MEDIUM", 20: "MEDIUM", 21: "HIGH"}


def test_sliding_windows_are_half_open(spark):
    rows = [(1, "a", T0 + dt.timedelta(minutes=5))]
    out = sliding_counts(_events(spark, rows), "5 minutes", "1 minute").collect()
    starts = sorted(r.window_start for r in out)
    assert starts[0] == T0 + dt.timedelta(minutes=1) and len(starts) == 5


def test_alert_crossing_mode(spark):
    rows = [(i, "a", T0 + dt.timedelta(seconds=i)) for i in range(30)]
    counts = trailing_count(_events(spark, rows), 3600)
    every = alert_records(counts, 10)
    crossing = alert_records(counts, 10, alert_on="crossing", window_seconds=3600)
    assert every.count() == 20 and crossing.count() == 1
    assert crossing.first().event_count == 11


def test_previous_within_equals_brute_force(spark):
    from blotter.operators.windows import previous_within
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "b", None]), T0 + dt.timedelta(seconds=rnd.randrange(0, 4 * 3600)))
            for i in range(300)]
    df = _events(spark, rows).withColumn("v", F.col("id") * 10)
    got = {r.id: r.prev for r in previous_within(df, 900, "v", "prev").collect()}
    want = {}
    for i, d, t in rows:
        earlier = [(t2, j) for j, d2, t2 in rows if d2 == d and (t2, j) < (t, i)]
        if earlier:
            t2, j = max(earlier)
            want[i] = j * 10 if (t - t2).total_seconds() <= 900 else None
        else:
            want[i] = None
    assert got == want


def test_trailing_count_on_zone_aware_timestamps(spark):
    rows = [(i, "a" if i % 3 else "b", T0 + dt.timedelta(seconds=37 * i)) for i in range(200)]
    ntz = _events(spark, rows)
    ltz = ntz.withColumn("ts", F.col("ts").cast("timestamp"))
    a = {r.id: r.event_count for r in trailing_count(ntz, 600).collect()}
    b = {r.id: r.event_count for r in trailing_count(ltz, 600).collect()}
    assert a == b == brute(rows, 600)


def test_global_position_is_the_rank_of_all_rows(spark):
    from blotter.operators.windows import global_position
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", None]), T0 + dt.timedelta(seconds=rnd.randrange(0, 600)))
            for i in range(250)]
    got = {r["id"]: r["__pos"] for r in global_position(_events(spark, rows), "district", "ts", "id").collect()}
    want = {i: n for n, (_, _, i) in enumerate(sorted((d or "", t, i) for i, d, t in rows), start=1)}
    assert got == want


@pytest.mark.parametrize("window, slide", [("5 minutes", "1 minute"), ("7 minutes", "3 minutes"), ("6 minutes", "4 minutes"), ("90 seconds", "90 seconds")])
def test_windows_of_panes_equal_the_window_function(spark, window, slide):
    """Adding up panes gives what grouping every event by window() gives, also before 1970 and where the slide does not divide the window."""
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "b", None]), T0 + dt.timedelta(milliseconds=rnd.randrange(0, 3_600_000))) for i in range(300)]
    rows += [(900 + i, "old", dt.datetime(1969, 12, 31, 23, 50 + i, 7)) for i in range(8)] + [(950, "a", None)]
    df = _events(spark, rows)
    for events in (df, df.withColumn("ts", F.col("ts").cast("timestamp"))):
        got = {(r.window_start, r.window_end, r.district): r.event_count for r in sliding_counts(events, window, slide).collect()}
        want = {(r.w.start, r.w.end, r.district): r.n for r in events.groupBy(F.window("ts", window, slide).alias("w"), "district").agg(F.count("*").alias("n")).collect()}
        assert got == want
    with pytest.raises(ValueError):
        sliding_counts(df, "1 month", "1 day")


def test_newest_first_equals_all_alerts(spark):
    """Bursts, silence, ties at the cut and too few alerts: the newest n are those of the whole history."""
    from blotter.plans.serving import newest_alerts, newest_first
    rnd = random.Random(6)
    rows = []
    for burst in range(12):
        at = T0 + dt.timedelta(hours=burst * burst)
        rows += [(len(rows) + i, rnd.choice(["a", "b", None]), at + dt.timedelta(seconds=rnd.randrange(0, 600) // 60 * 60)) for i in range(40)]
    rows += [(9000, "a", None), (9001, "quiet", T0 + dt.timedelta(days=6))]
    df = _events(spark, rows)
    every = alert_records(trailing_count(df, 7200), 9)
    for n in (50, 10_000):
        got = [tuple(r) for r in newest_first(df, n, 7200, 9).collect()]
        assert got == [tuple(r) for r in newest_alerts(every, n).collect()] and len(got) == min(n, every.count())
    assert newest_first(df.limit(0), 5, 7200, 9).count() == 0


def test_newest_first_counts_a_slice_only(spark, monkeypatch):
    from blotter.plans import serving
    rows = [(i, "a", T0 + dt.timedelta(minutes=i)) for i in range(3000)]
    seen = []
    plain = serving.trailing_count
    monkeypatch.setattr(serving, "trailing_count", lambda df, *a, **k: (seen.append(df.count()), plain(df, *a, **k))[1])
    assert serving.newest_first(_events(spark, rows), 10, 600, 3).count() == 10 and len(seen) == 1 and seen[0] <= 21
