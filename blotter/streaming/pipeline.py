"""Streaming alert pipeline.

    readStream -> from_json -> validate -> (accepted, rejected)
    accepted -> foreachBatch: trailing count over history + batch
             -> filter(count > threshold) -> alert projection
             -> alert rows (Parquet/JDBC) + alert documents (JSON)

Delivery: the source is replayable (files or a broker), progress is
checkpointed in a folder the caller names (a restart must find it again), and
sinks overwrite what they wrote under the same query name and micro-batch id,
so a batch replayed after a failure replaces its own output: each event yields
its alert exactly once. A query started on a fresh checkpoint counts its
batches from 0 again; under a new name it leaves older output alone. Each
micro-batch is persisted while its sinks run, so the source is read once.

State, two modes. (1) Table state (``table_state_alert_sink``, the default of
the command line): the in-window events are a Parquet table versioned by batch
id and each micro-batch runs the distributed ``trailing_count`` over history +
batch, so no district is ever one group. (2) State store
(``blotter.streaming.slots.trailing_count_stream``): state by (district, time
slot), with whole slots inside a window as counts, so the rows of one slot are
the largest group. Late rows count by their own time. For in-order input both
equal ``blotter.operators.windows.trailing_count``.

Sources: files with ``id, ts, value`` rows, or broker records mapped by
``from_broker_rows``. Messages without a time are rejected. Sinks: ``batch_sink``
(rows + JSON documents), ``jdbc_target`` (a database table),
``raw_event_sink`` (accepted events), ``publish_messages`` (producer side).
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators import alerts as AL
from blotter.operators import messages as MS
from blotter.operators.windows import micros
from blotter.session import delete_path, path_exists, scratch_path
from blotter.streaming.slots import trailing_count_stream


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None,
                  options: dict | None = None) -> DataFrame:
    """Message source: files (parquet/json with ``id, ts, value``) or any streaming format.

    For a broker pass e.g. ``fmt="kafka"`` and its options and map the records
    with ``from_broker_rows`` (``value`` text, event time ``ts``, arrival ``id``).
    """
    r = spark.readStream.format(fmt)
    if schema:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path) if path else r.load()


def publish_messages(incidents: DataFrame, path: str | None = None, fmt: str = "text",
                     options: dict | None = None, mode: str = "append") -> None:
    """Publish incidents as event messages (JSON ``value``, case number as ``key``).

    Only rows with a case number and a district are sent. ``fmt="text"``
    writes JSON lines to ``path``; a broker format (e.g. ``"kafka"`` with its
    ``topic`` / bootstrap options) receives ``key`` and ``value`` columns.
    Columns: those of ``operators.messages.incident_fields`` (any may be absent).
    """
    fields = MS.incident_fields(incidents)
    out = incidents.filter(MS.publishable(fields)).select(
        fields["CASE NUMBER"].cast("string").alias("key"), MS.to_message(fields).alias("value"))
    if fmt == "text":
        out.select("value").write.mode(mode).text(path)
        return
    w = out.write.mode(mode).format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if path:
        w.save(path)
    else:
        w.save()


def from_broker_rows(df: DataFrame) -> DataFrame:
    """Map broker records (Kafka source schema: key, value, topic, partition, offset,
    timestamp, ...) to the message rows the pipeline reads: ``id, ts, value``.

    ``id`` is the record's offset, which orders records as they arrived within a
    partition; records of different topics or partitions may share it, and count
    as separate events. ``ts`` is the record timestamp as a wall-clock NTZ value
    in UTC, independent of the session zone.
    """
    ntz_epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    return df.select(
        F.col("offset").cast("long").alias("id"),
        F.expr(f"timestampadd(MICROSECOND, unix_micros(timestamp), {ntz_epoch})").alias("ts"),
        F.col("value").cast("string").alias("value"))


def validated_stream(messages: DataFrame, keep=("id", "ts")):
    """(accepted, rejected) streams from the JSON ``value`` column."""
    v = MS.with_validation(MS.parse_messages(messages))
    return MS.accepted(v, keep=keep), MS.rejected(v, keep=keep)


def sliding_window_stream(accepted: DataFrame, window: str, slide: str, watermark: str) -> DataFrame:
    """Count per (sliding window, district); watermark bounds the open windows.

    ``withWatermark`` needs a TIMESTAMP (not NTZ) column. The NTZ event time is
    moved through its microsecond value (not a zone-dependent cast), so the
    windows align on the wall clock exactly as the batch form's, whatever the
    session time zone; they are reported back as NTZ values.
    """
    ntz_epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    ev = (accepted.withColumn("__ets", F.timestamp_micros(micros(accepted, "ts")))
          .withWatermark("__ets", watermark))
    back = lambda c: F.expr(f"timestampadd(MICROSECOND, unix_micros({c}), {ntz_epoch})")
    return (ev.groupBy(F.window("__ets", window, slide).alias("w"), "district")
            .agg(F.count(F.lit(1)).alias("event_count"))
            .select(back("w.start").alias("window_start"), back("w.end").alias("window_end"),
                    "district", "event_count"))


def build_alert_stream(messages: DataFrame, window_seconds: int, threshold: int,
                       alert_on: str = "event", clock: str = "event") -> DataFrame:
    """messages -> alert rows (district, timestamp, event_count, threshold, severity).

    ``clock="event"`` (default) counts on the message's own time ``ts``;
    ``clock="processing"`` stamps each micro-batch with its processing time
    (rows of one batch then tie and are ordered by ``id``), as a wall-clock
    alerting service would.
    Counters (events processed, alerts raised) are observed per micro-batch:
    ``query.lastProgress["observedMetrics"]["stream_counters"]``.
    Only per-event alerts are streamed; crossing alerts need the batch form
    (``operators.alerts.alert_records(alert_on="crossing")``).
    """
    if alert_on != "event":
        raise ValueError("the stream emits per-event alerts; crossing alerts use the batch form")
    accepted, _ = validated_stream(messages)
    if clock == "processing":
        accepted = accepted.withColumn("ts", F.current_timestamp().cast("timestamp_ntz"))
    counts = trailing_count_stream(accepted, window_seconds)
    counts = counts.observe("stream_counters", F.count(F.lit(1)).alias("processed"),
                            F.count_if(F.col("event_count") > F.lit(threshold)).alias("alerts"))
    return AL.alert_records(counts, threshold)


def build_window_alert_stream(messages: DataFrame, window: str, slide: str, watermark: str,
                              threshold: int) -> DataFrame:
    """messages -> sliding-window alerts (the documented form: a count per window and district).

    Run in ``update`` mode: a window's row is re-emitted while its count grows,
    so the latest row per (window, district) is the final one; windows close
    once the watermark passes their end.
    """
    accepted, _ = validated_stream(messages)
    return AL.window_alert_records(sliding_window_stream(accepted, window, slide, watermark), threshold)


def raw_event_sink(accepted: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Persist every accepted event as Parquet (the raw-event collection)."""
    w = (accepted.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def rejected_event_sink(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Dead-letter sink: every rejected message with its raw text and the missing fields."""
    _, rejected = validated_stream(messages)
    w = (rejected.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


@contextmanager
def persisted(batch: DataFrame) -> Iterator[DataFrame]:
    """A micro-batch computed once for all that is written from it."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield batch
    finally:
        batch.unpersist()


def batch_folder(base: str, query: str, batch_id: int) -> str:
    """Where a sink keeps the output of one micro-batch of one query."""
    return f"{base.rstrip('/')}/query={query}/batch_id={batch_id}"


def run_sql(spark: SparkSession, url: str, properties: dict, sql: str) -> None:
    """One statement on a JDBC connection of the driver."""
    props = spark.sparkContext._jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    con = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        con.createStatement().executeUpdate(sql)
    finally:
        con.close()


def jdbc_target(url: str, table: str, properties: dict | None = None, execute=run_sql):
    """Writer of a micro-batch into a database table: delete what the query wrote for the batch, then append.

    The table has the row's columns and ``query_name``, ``batch_id``. ``execute``
    runs the delete (replaceable where there is no database).
    """
    props = dict(properties or {})

    def write(batch: DataFrame, query: str, batch_id: int) -> None:
        name = query.replace("'", "''")
        execute(batch.sparkSession, url, props, f"DELETE FROM {table} WHERE query_name = '{name}' AND batch_id = {int(batch_id)}")
        batch.withColumns({"query_name": F.lit(query), "batch_id": F.lit(int(batch_id)).cast("long")}).write.jdbc(url, table, "append", props)
    return write


def batch_sink(out_dir: str | None, docs_dir: str | None = None, fmt: str = "parquet", mart: str | None = None, query: str = "alerts", jdbc=None):
    """foreachBatch writer: overwrites the query's ``batch_id=<n>``, so a replay is idempotent.

    Each target is written independently; rows as files (``out_dir``), documents
    (``docs_dir``) and database rows (``jdbc``, a ``jdbc_target``) are optional.
    ``mart="alerts"`` conforms the rows to the stored alerts schema and adds
    the ``created_at`` audit time, as the alerts table does on insert.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if mart:
            from blotter.sources.marts import conform
            batch = conform(batch, mart)
        with persisted(batch) as rows:
            if out_dir:
                rows.write.mode("overwrite").format(fmt).save(batch_folder(out_dir, query, batch_id))
            if docs_dir:
                (rows.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                 .json(batch_folder(docs_dir, query, batch_id)))
            if jdbc:
                jdbc(rows, query, batch_id)
    return write


HISTORY_SCHEMA = "id long, ts timestamp_ntz, district string"
#: History versions kept: the one read, the one written, and one for a replay.
VERSIONS = 3


def table_state_alert_sink(history_dir: str, out_dir: str | None, window_seconds: int, threshold: int,
                           docs_dir: str | None = None, query: str = "alerts", mart: str | None = None, jdbc=None, sink=None):
    """foreachBatch writer keeping the window state as a versioned table instead of in a state store.

    Batch ``n`` reads history version ``n-1`` (the events still inside the
    window), unions the accepted events of the batch, and runs the batch
    operator ``trailing_count``, so a district holding a third of a micro-batch
    is spread over many tasks. It writes the batch's alerts and history version
    ``n`` (events with time >= newest of their district - W), both keyed by the
    query and the batch id: a replayed batch re-reads the same version and
    overwrites its own outputs. A missing version raises, because the window
    would silently start empty; versions beyond ``VERSIONS`` are deleted.
    Input: accepted events with ``id, ts, district``. ``sink`` takes the alerts
    in place of ``batch_sink`` (see ``streaming.commits``).
    """
    from blotter.operators.windows import trailing_count
    w_us = int(window_seconds) * 1_000_000
    base = f"{history_dir.rstrip('/')}/query={query}"
    sink = sink or batch_sink(out_dir, docs_dir, mart=mart, query=query, jdbc=jdbc)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            hist = spark.createDataFrame([], HISTORY_SCHEMA)
        elif path_exists(spark, f"{base}/v={batch_id - 1}"):
            hist = spark.read.schema(HISTORY_SCHEMA).parquet(f"{base}/v={batch_id - 1}")
        else:
            raise RuntimeError(f"history version {batch_id - 1} of query {query} is missing under {base}")
        new = batch.select("id", "ts", "district").withColumn("__new", F.lit(True))
        with persisted(hist.withColumn("__new", F.lit(False)).unionByName(new)) as both:
            work = f"{base}/work/batch_id={batch_id}"
            try:
                counts = trailing_count(both, window_seconds, work=work)
                sink(AL.alert_records(counts.filter("__new"), threshold), batch_id)
            finally:
                delete_path(spark, work)
                delete_path(spark, f"{work}-rows")
            t = micros(both, "ts")
            newest = both.groupBy(F.col("district").alias("__d")).agg(F.max(t).alias("__newest"))
            keep = (both.join(newest, F.col("district").eqNullSafe(F.col("__d")))
                    .filter(t >= F.col("__newest") - F.lit(w_us)).select("id", "ts", "district"))
            keep.write.mode("overwrite").parquet(f"{base}/v={batch_id}")
        delete_path(spark, f"{base}/v={batch_id - VERSIONS}")
    return write


def run_available_now(df: DataFrame, sink, checkpoint: str, output_mode: str = "append",
                      name: str | None = None):
    """Process everything available, then stop (the catch-up / idle-stop mode)."""
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink).trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    return q


def until_idle(query, idle_seconds: float, poll_seconds: float = 0.2) -> None:
    """Let a running query (e.g. with a processing-time trigger) go on until it has had no input for a while, then stop it.

    Idle time runs only while no micro-batch is being worked on, from the last
    one that had rows. A query that fails raises its error here.
    """
    seen, since = -1, time.monotonic()
    while query.isActive:
        rows = [p["batchId"] for p in query.recentProgress if p["numInputRows"] > 0]
        if query.status["isTriggerActive"] or max(rows, default=-1) > seen:
            seen, since = max(rows, default=-1), time.monotonic()
        if time.monotonic() - since >= idle_seconds:
            query.stop()
            break
        time.sleep(poll_seconds)
    if query.exception():
        raise query.exception()


MESSAGE_SCHEMA = "id long, ts timestamp_ntz, value string"


def arrivals(messages: DataFrame, path: str, chunks: int, by: Column | None = None) -> Iterator[int]:
    """Append the message rows to ``path`` as ``chunks`` arrivals in time order; yields after each.

    Every arrival is written by as many tasks as hold its rows. The consumer
    runs its stream between arrivals, so replay order never rests on file
    times. Rows without a time arrive first. ``by`` gives the arrival of each
    row (0 to ``chunks`` - 1) in place of its time.
    """
    if by is not None:
        with persisted(messages.withColumn("__c", by)) as rows:
            for i in range(chunks):
                rows.filter(F.col("__c") == i).drop("__c").write.mode("append").parquet(path)
                yield i
        return
    t = micros(messages, "ts")
    with persisted(messages.withColumn("__t", t)) as rows:
        bounds = rows.agg(F.min("__t").alias("lo"), F.max("__t").alias("hi")).first()
        lo, hi = int(bounds["lo"] or 0), int(bounds["hi"] or 0) + 1
        step = -(-(hi - lo) // chunks)
        for i in range(chunks):
            here = (F.col("__t") >= F.lit(lo + i * step)) & (F.col("__t") < F.lit(lo + (i + 1) * step))
            rows.filter(here | F.col("__t").isNull() if i == 0 else here).drop("__t").write.mode("append").parquet(path)
            yield i


def replay(spark: SparkSession, messages: DataFrame, work: str, chunks: int, build, sink, output_mode: str = "append", by: Column | None = None) -> None:
    """One catch-up run of the stream per arrival, on one checkpoint.

    ``build`` maps the message stream to the stream that ``sink`` gets.
    """
    for _ in arrivals(messages, f"{work}/source", chunks, by):
        stream = read_messages(spark, f"{work}/source", "parquet", schema=MESSAGE_SCHEMA)
        run_available_now(build(stream), sink, f"{work}/checkpoint", output_mode)


def accepted_events(messages: DataFrame) -> DataFrame:
    """What the alert sinks take: the accepted messages' id, time and district."""
    parsed = MS.with_validation(MS.parse_messages(messages, fields=("DISTRICT",)))
    return MS.accepted(parsed, keep=("id", "ts")).select("id", "ts", "district")


ALERT_COLUMNS = ["district", "timestamp", "event_count", "threshold", "severity"]


def stream_alerts(spark: SparkSession, messages: DataFrame, window_seconds: int, threshold: int,
                  chunks: int = 4, work: str | None = None) -> DataFrame:
    """Run the alert stream (table state) over ``messages``; read the alert rows."""
    work = work or scratch_path(spark, "stream")
    sink = table_state_alert_sink(f"{work}/history", f"{work}/alerts", window_seconds, threshold, mart="alerts")
    replay(spark, messages, work, chunks, accepted_events, sink)
    return spark.read.parquet(f"{work}/alerts").select(*ALERT_COLUMNS)


def stream_alerts_state_store(spark: SparkSession, messages: DataFrame, window_seconds: int, threshold: int,
                              chunks: int = 4, work: str | None = None) -> DataFrame:
    """Run the alert stream with the window in the state store; read the alert rows."""
    work = work or scratch_path(spark, "stream-store")
    replay(spark, messages, work, chunks, lambda m: build_alert_stream(m, window_seconds, threshold), batch_sink(f"{work}/alerts", mart="alerts"))
    return spark.read.parquet(f"{work}/alerts").select(*ALERT_COLUMNS)


def stream_alert_documents(spark: SparkSession, messages: DataFrame, window_seconds: int, threshold: int,
                           chunks: int = 4, work: str | None = None) -> DataFrame:
    """Run the alert stream into both sinks; read the document copy."""
    from blotter.sources.marts import read_alert_docs
    work = work or scratch_path(spark, "stream-docs")
    sink = table_state_alert_sink(f"{work}/history", f"{work}/alerts", window_seconds, threshold, docs_dir=f"{work}/docs")
    replay(spark, messages, work, chunks, accepted_events, sink)
    return read_alert_docs(spark, f"{work}/docs").select(*ALERT_COLUMNS)


def stream_rejected(spark: SparkSession, messages: DataFrame, chunks: int = 4, work: str | None = None) -> DataFrame:
    """Run the dead-letter sink over ``messages``; read it."""
    work = work or scratch_path(spark, "stream-rejected")
    for _ in arrivals(messages, f"{work}/source", chunks):
        stream = read_messages(spark, f"{work}/source", "parquet", schema=MESSAGE_SCHEMA)
        rejected_event_sink(stream, f"{work}/rejected", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/rejected")


def committed_run(spark: SparkSession, messages: DataFrame, window_seconds: int, threshold: int, chunks: int = 4, work: str | None = None,
                  delay_seconds: int | None = None, by: Column | None = None) -> str:
    """Run the committed alert sink over ``messages``, each arrival by a new query object; returns the folder to read.

    Every run after the first is a restart: new reader, new sink, only the
    checkpoint, history, watermark and manifest in storage.
    """
    from blotter.streaming.commits import committed_alert_sink, judged_messages
    work = work or scratch_path(spark, "stream-committed")
    for _ in arrivals(messages, f"{work}/source", chunks, by):
        stream = read_messages(spark, f"{work}/source", "parquet", schema=MESSAGE_SCHEMA)
        sink = committed_alert_sink(f"{work}/out", window_seconds, threshold, delay_seconds=delay_seconds)
        run_available_now(judged_messages(stream), sink, f"{work}/checkpoint")
    return f"{work}/out"


def stream_idle_stop(spark: SparkSession, messages: DataFrame, chunks: int = 4, idle_seconds: float = 2.0, work: str | None = None) -> DataFrame:
    """Run the raw-event sink on a processing-time trigger while messages arrive, stop it once idle; read it."""
    work = work or scratch_path(spark, "stream-idle")
    coming = arrivals(messages, f"{work}/source", chunks)
    next(coming)
    stream = read_messages(spark, f"{work}/source", "parquet", schema=MESSAGE_SCHEMA)
    query = raw_event_sink(validated_stream(stream)[0], f"{work}/raw", f"{work}/checkpoint", {"processingTime": "500 milliseconds"})
    for _ in coming:
        pass
    until_idle(query, idle_seconds)
    return spark.read.parquet(f"{work}/raw")


def stream_raw_events(spark: SparkSession, messages: DataFrame, chunks: int = 4, work: str | None = None) -> DataFrame:
    """Run the raw-event sink over ``messages``; read it."""
    work = work or scratch_path(spark, "stream-raw")
    for _ in arrivals(messages, f"{work}/source", chunks):
        stream = read_messages(spark, f"{work}/source", "parquet", schema=MESSAGE_SCHEMA)
        raw_event_sink(validated_stream(stream)[0], f"{work}/raw", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/raw")


def stream_window_alerts(spark: SparkSession, messages: DataFrame, window: str, slide: str, watermark: str, threshold: int,
                         chunks: int = 4, work: str | None = None) -> DataFrame:
    """Run the sliding-window stream from panes into an alert sink; the final alert of each window and district."""
    from blotter.streaming.panes import pane_stream, window_sink
    work = work or scratch_path(spark, "stream-window-alerts")
    rows = batch_sink(f"{work}/alerts")
    sink = window_sink(f"{work}/panes", window, slide, watermark, lambda windows, n: rows(AL.window_alert_records(windows, threshold), n))
    replay(spark, messages, work, chunks, lambda m: pane_stream(validated_stream(m)[0], window, slide, watermark), sink, output_mode="update")
    last = F.max(F.struct("event_count", "threshold", "severity")).alias("last")
    found = spark.read.parquet(f"{work}/alerts").groupBy("district", "window_start", "window_end").agg(last)
    return found.select("district", "window_start", "window_end", "last.*")


def stream_window_counts(spark: SparkSession, messages: DataFrame, window: str, slide: str,
                         watermark: str, chunks: int = 4, work: str | None = None) -> DataFrame:
    """Sliding-window counts of the stream from panes; the final count of each window."""
    from blotter.streaming.panes import pane_stream, window_sink
    work = work or scratch_path(spark, "stream-windows")
    sink = window_sink(f"{work}/panes", window, slide, watermark, batch_sink(f"{work}/windows"))
    replay(spark, messages, work, chunks, lambda m: pane_stream(validated_stream(m)[0], window, slide, watermark), sink, output_mode="update")
    return (spark.read.parquet(f"{work}/windows").groupBy("window_start", "window_end", "district")
            .agg(F.max("event_count").alias("event_count")))
