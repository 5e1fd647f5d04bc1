"""Serving queries over the marts (what a dashboard asks).

Each function takes mart DataFrames and returns a small DataFrame; top-k
reports end in ``orderBy(...).limit(k)`` which Spark plans as
``TakeOrderedAndProject`` (a per-partition top-k, then a k-row merge), never a
full sort. Every order has a unique tiebreaker so the cut is reproducible.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions import day_name, month_name
from blotter.operators.alerts import alert_records
from blotter.operators.windows import instant, micros, trailing_count
from blotter.schemas import GT_DAY_OF_WEEK, GT_DISTRICT, GT_MONTH, GT_YEAR
from blotter.session import scratch_path


def kpi_overview(alerts: DataFrame, trends: DataFrame, hotspots: DataFrame,
                 violence_stats: DataFrame) -> DataFrame:
    """One row: alert count, incident total (year rows), hotspot count, violence total.

    Each figure is a scalar subquery over its mart, empty marts give 0.
    """
    incidents_total = F.coalesce(trends.filter(F.col("group_type") == GT_YEAR)
                                 .agg(F.sum("crime_count")).scalar(), F.lit(0)).cast("bigint")
    violence_total = F.coalesce(violence_stats.filter(F.col("group_type") == GT_DISTRICT)
                                .agg(F.sum("total_incidents")).scalar(), F.lit(0)).cast("bigint")
    return alerts.agg(F.count(F.lit(1)).alias("alerts_triggered")).select(
        "alerts_triggered",
        incidents_total.alias("total_records"),
        hotspots.agg(F.count(F.lit(1))).scalar().alias("hotspot_clusters"),
        violence_total.alias("violence_incidents"))


def newest_alerts(alerts: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` alerts (ties: district, then higher count first)."""
    return alerts.orderBy(F.col("timestamp").desc(), F.col("district").asc(),
                          F.col("event_count").desc()).limit(n)


def newest_first(events: DataFrame, n: int, window_seconds: int, threshold: int, clock: DataFrame | None = None,
                 key: str = "district", ts: str = "ts", order: str = "id") -> DataFrame:
    """The newest ``n`` alerts straight from the events, counting only as far back as they need.

    Only events of ``[newest - d - W, newest]`` are counted. An alert at or
    after ``newest - d`` has its whole window in there, so its count is exact
    and no later alert is missed; d starts at W and doubles until n alerts are
    found or all events are in, which takes a logarithmic number of rounds.
    ``clock`` is where the first and last time are read (default: the events;
    any table with their times, such as the unparsed messages, will do). Events
    without a time raise no alert.
    """
    w_us = int(window_seconds) * 1_000_000
    source = events if clock is None else clock
    seen = source.agg(F.min(micros(source, ts)).alias("first"), F.max(micros(source, ts)).alias("last")).first()
    path = scratch_path(events.sparkSession, f"newest-{uuid.uuid4().hex[:12]}")
    first, last, reach = seen["first"] or 0, seen["last"] or 0, w_us
    since = lambda back: F.col(ts) >= instant(events, ts, last - back)
    while True:
        counts = trailing_count(events.where(since(reach + w_us)), window_seconds, key=key, ts=ts, order=order)
        found = alert_records(counts.where(since(reach)), threshold, key=key, ts=ts)
        newest_alerts(found, n).write.mode("overwrite").parquet(path)
        newest = events.sparkSession.read.schema(found.schema).parquet(path)
        if last - reach <= first or newest.count() >= n:
            return newest_alerts(newest, n)
        reach *= 2


def severity_mix(alerts: DataFrame, newest: int = 50) -> DataFrame:
    """Severity distribution of the newest alerts."""
    return newest_alerts(alerts, newest).groupBy("severity").agg(F.count(F.lit(1)).alias("alert_count"))


def top_by(mart: DataFrame, group_type: str, measure: str, k: int) -> DataFrame:
    """Top ``k`` groups of one type by a measure (ties: group value, NULL first)."""
    return (mart.filter(F.col("group_type") == group_type)
            .orderBy(F.col(measure).desc(), F.col("group_value").asc_nulls_first()).limit(k))


def mart_slice(mart: DataFrame, group_type: str, order: str = "group_value", descending: bool = False,
               numeric: bool = False) -> DataFrame:
    """Rows of one group type, sorted for display.

    The ``group_type`` filter prunes to one partition folder of a stored mart.
    ``numeric`` sorts the string key as an integer ('10' after '9').
    """
    key = F.col(order).cast("int") if numeric else F.col(order)
    key = key.desc_nulls_last() if descending else key.asc_nulls_first()
    return mart.filter(F.col("group_type") == group_type).orderBy(key, F.col("group_value").asc_nulls_first())


def ranked_slice(mart: DataFrame, group_type: str, order: str = "group_value", descending: bool = False,
                 numeric: bool = False) -> DataFrame:
    """``mart_slice`` with its order as a column, ``position`` from 1 (a slice is a few rows, so one task ranks it)."""
    key = F.col(order).cast("int") if numeric else F.col(order)
    key = key.desc_nulls_last() if descending else key.asc_nulls_first()
    rank = F.row_number().over(Window.orderBy(key, F.col("group_value").asc_nulls_first()))
    return mart.filter(F.col("group_type") == group_type).withColumn("position", rank).orderBy("position")


def trend_labels(trends: DataFrame) -> DataFrame:
    """Trend rows with display labels and an integer sort key (string keys sort wrong)."""
    label = (F.when(F.col("group_type") == GT_MONTH, month_name("group_value"))
             .when(F.col("group_type") == GT_DAY_OF_WEEK, day_name("group_value"))
             .otherwise(F.col("group_value")))
    return trends.select("group_type", "group_value", "crime_count", label.alias("label"),
                         F.col("group_value").cast("int").alias("sort_key"))


#: Most keys whose latest times are broadcast.
BROADCAST_KEYS = 100_000


def busiest_now(events: DataFrame, window_seconds: int, k: int = 5, key: str = "district", ts: str = "ts") -> DataFrame:
    """Districts by their latest trailing count (the events of the window that ends with the key's last).

    The key and time of each event are written once; then two partial
    aggregations: the last time of each key, then the events at most W older. The
    last times (a row per key) are broadcast while there are few keys, so no
    event moves; beyond that the same join shuffles.
    """
    path = scratch_path(events.sparkSession, f"busiest-{uuid.uuid4().hex[:12]}")
    events.where(F.col(ts).isNotNull()).select(F.col(key), micros(events, ts).alias("__t")).write.parquet(path)
    timed = events.sparkSession.read.parquet(path)
    last = timed.groupBy(F.col(key).alias("__k")).agg(F.max("__t").alias("__last"))
    last = F.broadcast(last) if last.count() <= BROADCAST_KEYS else last
    near = timed.join(last, F.col(key).eqNullSafe(F.col("__k"))).where(F.col("__t") >= F.col("__last") - F.lit(int(window_seconds) * 1_000_000))
    counted = near.groupBy(key).agg(F.count(F.lit(1)).alias("window_size"))
    return counted.orderBy(F.col("window_size").desc(), F.col(key).asc()).limit(k)


def hotspots_ranked(hotspots: DataFrame) -> DataFrame:
    return hotspots.orderBy(F.col("crime_count").desc(), F.col("cluster_id").asc())
