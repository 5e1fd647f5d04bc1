"""Per-key event-time window counts.

``trailing_count`` is the batch form of the stream's per-event window: for
every event, the number of events with the same key in ``[t - W, t]`` that
arrived no later than it (exact-timestamp ties are broken by an order column,
as arrival order would, and then by row). The row exactly ``W`` old is kept.

Scale: one rule for every size and density. Positions replace frames: with
``rank(e)`` the number of events up to ``e`` in the order (key, time, order,
row) and ``before(e)`` the number before the moment ``t - W`` of its key, the
count is ``rank(e) - before(e)``. The rows are written once with a row number.
Of each only key, time, order and row number are put down twice, as the event
and as a probe at ``t - W``; the union is range-partitioned on the whole order,
so a key holding all rows, or all rows in one instant, is spread like any other.
The running count is taken along the sorted partition as it is written, without
another exchange, and the totals of the partitions before (one number each) make
it a position. Both positions and the whole row meet by row number. Rows whose
time is NULL are kept with a NULL count and counted by no one; repeated ids are
separate events.

``sliding_counts`` counts events once, by pane (the largest span that divides
window and slide), and then adds up the panes of each window, so the rows that
are multiplied by window / slide are counts and not events.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.session import scratch_path


def _micros_sql(df: DataFrame, ts: str) -> str:
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)"
    return f"unix_micros(`{ts}`)"


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970-01-01 of the wall clock (NTZ) or instant (LTZ)."""
    return F.expr(_micros_sql(df, ts))


def instant(df: DataFrame, ts: str, at: int) -> Column:
    """The moment ``at`` (microseconds) as a literal of the column's type, so that comparing with it reaches the scan."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.expr(f"timestampadd(MICROSECOND, {int(at)}, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return F.timestamp_micros(F.lit(int(at)))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: the rows of a partition with the running sum of their last column."""
    total = 0
    for batch in batches:
        run = np.cumsum(batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)) + total
        if len(run):
            total = int(run[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(run, pa.int64())], [*batch.schema.names, "__run"])


def _positions(rows: DataFrame, order: list[str], counted: str, work: str) -> DataFrame:
    """``rows`` (narrow: ``order`` and the last column ``counted``) with ``__g``, the running sum of ``counted`` in that order.

    Range partitions are written once to shared storage with their number, so
    the partition a row is in is fixed before anything is added up.
    """
    spark = rows.sparkSession
    schema = T.StructType([*rows.schema.fields, T.StructField("__run", T.LongType())])
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_running, schema)
    ranged.withColumn("__p", F.spark_partition_id()).write.mode("overwrite").parquet(work)
    ranged = spark.read.parquet(work)
    # one row per partition, so this window over all of them is small
    earlier = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    prior = (ranged.groupBy("__p").agg(F.sum(counted).alias("__n"))
             .select("__p", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__prior")))
    return ranged.join(prior, "__p").withColumn("__g", F.col("__prior") + F.col("__run")).drop("__p", "__prior", "__run")


def _written(df: DataFrame, ts: str, work: str) -> DataFrame:
    """``df`` written once with its time ``__t`` in microseconds and a row number ``__r``."""
    df.withColumns({"__t": micros(df, ts), "__r": F.monotonically_increasing_id()}).write.mode("overwrite").parquet(f"{work}-rows")
    return df.sparkSession.read.parquet(f"{work}-rows")


def _work(df: DataFrame, work: str | None) -> str:
    return work or scratch_path(df.sparkSession, f"positions-{uuid.uuid4().hex[:12]}")


def trailing_count(df: DataFrame, window_seconds: int, key: str = "district", ts: str = "ts", order: str = "id",
                   out: str = "event_count", work: str | None = None, position: str | None = None) -> DataFrame:
    """Append ``out`` = events of the same key in ``[ts - W, ts]`` up to this one; NULL where ``ts`` is.

    ``work`` names the folder of the intermediate tables (default: a new one
    under the checkpoint folder); ``position`` names one more column, the
    event's place in the order (key, time, order column, row) of all events.
    """
    w_us, work = int(window_seconds) * 1_000_000, _work(df, work)
    wide = _written(df, ts, work)
    both = wide.select(F.col(key).alias("__k"), F.col(order).alias("__o"), "__r", F.inline(F.array(
        F.struct(F.col("__t").alias("__at"), F.lit(1).alias("__kind")),
        F.struct((F.col("__t") - F.lit(w_us)).alias("__at"), F.lit(0).alias("__kind")))))
    placed = _positions(both, ["__k", "__at", "__kind", "__o", "__r"], "__kind", work)
    event = F.col("__kind") == 1
    paired = placed.groupBy("__r").agg(F.max(F.when(event, F.col("__g"))).alias("__g"), F.sum(F.when(event, F.col("__g")).otherwise(-F.col("__g"))).alias("__c"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    more = [F.col("__g").alias(position)] if position else []
    return wide.join(paired, "__r").select(*columns, F.when(F.col("__t").isNotNull(), F.col("__c")).alias(out), *more)


def global_position(df: DataFrame, key: str, ts: str, order: str, work: str | None = None, out: str = "__pos") -> DataFrame:
    """Append ``out``, the position in the order (key, time, order column, row) of all rows; positions of one key are consecutive."""
    work = _work(df, work)
    wide = _written(df, ts, work)
    narrow = wide.select(F.col(key).alias("__k"), "__t", F.col(order).alias("__o"), "__r", F.lit(1).alias("__one"))
    placed = _positions(narrow, ["__k", "__t", "__o", "__r"], "__one", work).select("__r", F.col("__g").alias(out))
    return wide.join(placed, "__r").select(*[F.col(f"`{c}`") for c in df.columns], out)


def previous_within(df: DataFrame, window_seconds: int, value: str, out: str, key: str = "district",
                    ts: str = "ts", order: str = "id", work: str | None = None, position: str | None = None) -> DataFrame:
    """Append ``out`` = ``value`` of the key's previous row (by ts, then order) if at most W older, else NULL.

    The previous row is the one at the position before, found by one equi-join
    on positions, which are unique. ``position`` names the column that holds
    them where ``trailing_count`` left one; else they are found first.
    """
    w_us = int(window_seconds) * 1_000_000
    placed = df if position else global_position(df, key, ts, order, work)
    at = position or "__pos"
    t = micros(df, ts)
    prev = placed.select(F.col(key).alias("__qk"), (F.col(at) + 1).alias(at), t.alias("__qt"), F.col(value).alias("__qv"))
    near = F.col(key).eqNullSafe(F.col("__qk")) & (t - F.col("__qt") <= F.lit(w_us))
    return placed.join(prev, at, "left").withColumn(out, F.when(near, F.col("__qv"))).select(*[F.col(f"`{c}`") for c in df.columns], out)


def _span_micros(span: str) -> int:
    """Microseconds of a window or slide such as ``"5 minutes"``."""
    found = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", span)
    if not found:
        raise ValueError(f"a span of whole seconds, minutes, hours or days is needed, not {span!r}")
    return int(found[1]) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[found[2]] * 1_000_000


def pane_span(window: str, slide: str) -> str:
    """The largest span that divides window and slide."""
    return f"{gcd(_span_micros(window), _span_micros(slide)) // 1_000_000} seconds"


def pane_counts(df: DataFrame, window: str, slide: str, key: str = "district", ts: str = "ts") -> DataFrame:
    """Events per (pane, key): pane_start, key, event_count."""
    pane = F.window(ts, pane_span(window, slide)).alias("w")
    return df.groupBy(pane, key).agg(F.count(F.lit(1)).alias("event_count")).select(F.col("w.start").alias("pane_start"), key, "event_count")


def windows_of_panes(panes: DataFrame, window: str, slide: str, key: str = "district") -> DataFrame:
    """Count per ``(window_start, window_end, key)`` from counts by pane (``pane_start``, key, ``event_count``)."""
    length, step, pane = _span_micros(window), _span_micros(slide), _span_micros(pane_span(window, slide))
    t = micros(panes, "pane_start")
    # windows start at multiples of the slide; those that hold the pane start between its end - window and itself
    last = t - F.pmod(t, F.lit(step))
    least = t + F.lit(pane - length)
    first = least + F.pmod(-least, F.lit(step))
    kind = "TIMESTAMP_NTZ" if isinstance(panes.schema["pane_start"].dataType, T.TimestampNTZType) else "TIMESTAMP"
    back = lambda c: F.expr(f"timestampadd(MICROSECOND, {c}, TIMESTAMP_NTZ'1970-01-01 00:00:00')") if kind == "TIMESTAMP_NTZ" else F.timestamp_micros(F.expr(c))
    spread = panes.select(key, "event_count", F.explode(F.when(first <= last, F.sequence(first, last, F.lit(step).cast("long")))).alias("__s"))
    summed = spread.groupBy("__s", key).agg(F.sum("event_count").alias("event_count"))
    return summed.select(back("__s").alias("window_start"), back(f"__s + {length}").alias("window_end"), key, "event_count")


def sliding_counts(df: DataFrame, window: str, slide: str, key: str = "district",
                   ts: str = "ts") -> DataFrame:
    """Count per ``(window_start, window_end, key)``; windows are half-open ``[start, end)``."""
    return windows_of_panes(pane_counts(df, window, slide, key, ts), window, slide, key)
