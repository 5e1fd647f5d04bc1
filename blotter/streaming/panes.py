"""Sliding-window counts of a stream from panes.

The stateful aggregation counts events by pane, the largest span that divides
window and slide, so an event is one row and one state entry whatever the
overlap of the windows. Each micro-batch's changed panes are merged into a
table of the open panes, and the windows that hold a changed pane are added up
from it: windows are made of panes, never of events.

A pane takes events until the watermark passes its end, and its count in the
table only grows, so the largest value is the newest. The pane table is
versioned by query and batch id like the history of the alert sink: a replayed
micro-batch reads the same version again and overwrites its own output, and a
missing version raises. A version keeps the panes that windows of panes still
open can need.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.windows import _span_micros, micros, pane_span, windows_of_panes
from blotter.session import delete_path, path_exists
from blotter.streaming.pipeline import VERSIONS, persisted

PANE_SCHEMA = "pane_start timestamp_ntz, district string, event_count long"


def pane_stream(accepted: DataFrame, window: str, slide: str, watermark: str) -> DataFrame:
    """Count per (pane, district) of a stream of accepted events; run it in ``update`` mode."""
    events = accepted.select("district", F.timestamp_micros(micros(accepted, "ts")).alias("__ets")).withWatermark("__ets", watermark)
    counted = events.groupBy(F.window("__ets", pane_span(window, slide)).alias("w"), "district").agg(F.count(F.lit(1)).alias("event_count"))
    start = F.expr("timestampadd(MICROSECOND, unix_micros(w.start), TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return counted.select(start.alias("pane_start"), "district", "event_count")


def window_sink(state_dir: str, window: str, slide: str, watermark: str, sink: Callable[[DataFrame, int], None], query: str = "windows") -> Callable:
    """foreachBatch writer of ``pane_stream``: passes ``sink`` the windows that changed.

    Rows: window_start, window_end, district, event_count, the count so far; a
    window comes again whenever it grows. Without changes an empty table is
    passed on.
    """
    base = f"{state_dir.rstrip('/')}/query={query}"
    reach = F.lit(_span_micros(watermark) + _span_micros(window) + _span_micros(pane_span(window, slide)))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            held = spark.createDataFrame([], PANE_SCHEMA)
        elif path_exists(spark, f"{base}/v={batch_id - 1}"):
            held = spark.read.schema(PANE_SCHEMA).parquet(f"{base}/v={batch_id - 1}")
        else:
            raise RuntimeError(f"pane version {batch_id - 1} of query {query} is missing under {base}")
        with persisted(batch) as changed:
            both = held.unionByName(changed).groupBy("pane_start", "district").agg(F.max("event_count").alias("event_count"))
            with persisted(both) as panes:
                touched = windows_of_panes(changed, window, slide).select("window_start", "district")
                sink(windows_of_panes(panes, window, slide).join(touched, ["window_start", "district"], "left_semi"), batch_id)
                newest = panes.agg(F.max(micros(panes, "pane_start"))).scalar()
                panes.filter(micros(panes, "pane_start") >= newest - reach).write.mode("overwrite").parquet(f"{base}/v={batch_id}")
        delete_path(spark, f"{base}/v={batch_id - VERSIONS}")
    return write
