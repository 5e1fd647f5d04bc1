"""Threshold alerts: strict ``>`` threshold, HIGH above twice the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.schemas import SEVERITY_HIGH, SEVERITY_MEDIUM


def severity(count: Column | str, threshold: int) -> Column:
    c = F.col(count) if isinstance(count, str) else count
    return F.when(c > F.lit(2 * threshold), F.lit(SEVERITY_HIGH)).otherwise(F.lit(SEVERITY_MEDIUM))


def over_threshold(df: DataFrame, threshold: int, count: str = "event_count") -> DataFrame:
    """Anomalies: rows whose count is strictly above the threshold."""
    return df.filter(F.col(count) > F.lit(threshold))


def alert_records(counts: DataFrame, threshold: int, key: str = "district", ts: str = "ts",
                  count: str = "event_count", alert_on: str = "event",
                  window_seconds: int | None = None, position: str | None = None) -> DataFrame:
    """One alert per event above threshold (``alert_on='event'``, the stored behaviour).

    ``alert_on='crossing'`` keeps only the events where the count crosses the
    threshold upwards (previous event of the key at or below it). It needs the
    window length: an event above a threshold >= 1 always has its predecessor
    within the window, so older ones need not be looked up. ``position`` names
    the column of positions, if ``trailing_count`` left one.
    """
    src = counts
    if alert_on == "crossing":
        from blotter.operators.windows import previous_within
        if threshold < 1 or not window_seconds:
            raise ValueError("crossing alerts need threshold >= 1 and window_seconds")
        src = previous_within(src, window_seconds, count, "__prev", key=key, ts=ts, position=position).filter(
            F.col("__prev").isNull() | (F.col("__prev") <= F.lit(threshold)))
    return over_threshold(src, threshold, count).select(
        F.col(key).cast("string").alias("district"),
        F.col(ts).alias("timestamp"),
        F.col(count).cast("int").alias("event_count"),
        F.lit(threshold).cast("int").alias("threshold"),
        severity(count, threshold).alias("severity"))


def window_alert_records(windows: DataFrame, threshold: int) -> DataFrame:
    """Alerts from sliding-window counts (one per window and key above threshold)."""
    return over_threshold(windows, threshold).select(
        "district", "window_start", "window_end",
        F.col("event_count").cast("int").alias("event_count"),
        F.lit(threshold).cast("int").alias("threshold"),
        severity("event_count", threshold).alias("severity"))
