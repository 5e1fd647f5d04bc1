"""Committed stream output: both sinks, late rows and counters of a micro-batch appear together.

``committed_alert_sink`` writes what a micro-batch yields (alert rows, alert
documents, late events) into a folder of its own for every attempt, and then
one manifest file that names the attempt and holds the batch's counters.
Readers (``read_committed``) follow the manifest: a batch that is half written,
is being replayed or was given up is not there for them, and both copies of its
alerts appear at once. A replay writes a new attempt, replaces the manifest
file and deletes the attempt that the file named before.

Late events: with ``delay_seconds`` the watermark of batch n is the greatest
event time up to it less the delay, kept as a table of one row per batch (a
replay reads the same one). Accepted events of batch n below the watermark of
batch n - 1 are put aside in ``late`` and not counted; all others are, so
counted plus late equals accepted. Without a delay nothing is late.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators import messages as MS
from blotter.operators.windows import micros
from blotter.schemas import AUDIT_COLUMNS, MARTS
from blotter.session import delete_path, path_exists, put_path
from blotter.sources.marts import ALERT_DOC_OPTIONS, conform
from blotter.streaming.pipeline import batch_folder, persisted, table_state_alert_sink

MANIFEST_SCHEMA = "query string, batch_id long, attempt string, processed long, rejected long, late long, alerts long"
LATE_SCHEMA = "id long, ts timestamp_ntz, district string"
COUNTERS = ["processed", "rejected", "late", "alerts"]


def judged_messages(messages: DataFrame) -> DataFrame:
    """What the committed sink takes: every message's id, time and district, and whether it is valid."""
    parsed = MS.with_validation(MS.parse_messages(messages, fields=("DISTRICT",)))
    return parsed.select("id", "ts", F.col("msg").getField("DISTRICT").alias("district"), "valid")


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """One row per committed micro-batch, with its counters."""
    base = base.rstrip("/")
    if not path_exists(spark, f"{base}/manifest"):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{base}/manifest")


def read_committed(spark: SparkSession, base: str, what: str = "alerts") -> DataFrame:
    """The committed rows of ``what`` (``alerts``, ``docs`` or ``late``) with query and batch_id."""
    base = base.rstrip("/")
    schema = T.StructType.fromDDL(LATE_SCHEMA) if what == "late" else MARTS["alerts"]
    if what == "alerts":
        schema = T.StructType([*schema.fields, T.StructField(AUDIT_COLUMNS["alerts"], T.TimestampNTZType())])
    schema = T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in (("query", T.StringType()), ("batch_id", T.LongType()), ("attempt", T.StringType())))])
    if not path_exists(spark, f"{base}/{what}"):
        return spark.createDataFrame([], schema).drop("attempt")
    source = spark.read.schema(schema)
    rows = source.options(**ALERT_DOC_OPTIONS).json(f"{base}/{what}") if what == "docs" else source.parquet(f"{base}/{what}")
    committed = read_manifest(spark, base).select("query", "batch_id", "attempt")
    return rows.join(committed, ["query", "batch_id", "attempt"], "left_semi").drop("attempt")


def _watermark(spark: SparkSession, base: str, query: str, batch_id: int) -> int | None:
    """The watermark (microseconds) that batch ``batch_id`` left; None before the first."""
    if batch_id < 0:
        return None
    path = batch_folder(f"{base}/watermark", query, batch_id)
    if not path_exists(spark, path):
        raise RuntimeError(f"the watermark of batch {batch_id} of query {query} is missing under {base}")
    return spark.read.schema("mark long").parquet(path).agg(F.max("mark")).first()[0]


def committed_alert_sink(base: str, window_seconds: int, threshold: int, query: str = "alerts", delay_seconds: int | None = None):
    """foreachBatch writer of judged messages: trailing counts with table state, committed alerts, documents, late events and counters."""
    base = base.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, attempt, counted = batch.sparkSession, f"a{uuid.uuid4().hex}", {}

        def folder(what: str) -> str:
            return f"{batch_folder(f'{base}/{what}', query, batch_id)}/attempt={attempt}"

        def alerts_out(alerts: DataFrame, _: int) -> None:
            seen = Observation()
            with persisted(conform(alerts, "alerts").observe(seen, F.count(F.lit(1)).alias("alerts"))) as rows:
                rows.write.parquet(folder("alerts"))
                rows.drop(AUDIT_COLUMNS["alerts"]).write.options(**ALERT_DOC_OPTIONS).json(folder("docs"))
            counted["alerts"] = seen.get["alerts"]

        with persisted(batch) as judged:
            accepted = judged.where("valid").select("id", "ts", "district")
            t = micros(accepted, "ts")
            mark = _watermark(spark, base, query, batch_id - 1) if delay_seconds is not None else None
            late = t < F.lit(mark) if mark is not None else F.lit(False)
            totals = judged.agg(F.count(F.lit(1)).alias("all"), F.count_if("valid").alias("valid"), F.max(F.when(F.col("valid"), micros(judged, "ts"))).alias("newest"),
                                F.count_if(F.col("valid") & late).alias("late")).first()
            if totals["late"]:
                accepted.where(late).write.parquet(folder("late"))
            table_state_alert_sink(f"{base}/history", None, window_seconds, threshold, query=query, sink=alerts_out)(accepted.where(~late), batch_id)
        if delay_seconds is not None:
            reached = [m for m in (mark, None if totals["newest"] is None else totals["newest"] - int(delay_seconds) * 1_000_000) if m is not None]
            spark.createDataFrame([(max(reached, default=None),)], "mark long").write.mode("overwrite").parquet(batch_folder(f"{base}/watermark", query, batch_id))

        before = [r.attempt for r in read_manifest(spark, base).where((F.col("query") == query) & (F.col("batch_id") == batch_id)).collect()]
        row = (query, batch_id, attempt, totals["valid"] - totals["late"], totals["all"] - totals["valid"], totals["late"], counted["alerts"])
        aside = f"{base}/_manifest-{attempt}"
        spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.json(aside)
        put_path(spark, aside, batch_folder(f"{base}/manifest", query, batch_id))
        for old in before:
            for what in ("alerts", "docs", "late"):
                delete_path(spark, f"{batch_folder(f'{base}/{what}', query, batch_id)}/attempt={old}")
    return write


def stream_counters(spark: SparkSession, base: str) -> DataFrame:
    """Counters of the whole run: batches committed, events counted, messages rejected, late events, alerts."""
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS]
    return read_manifest(spark, base).agg(F.count(F.lit(1)).alias("batches"), *total)
