"""Mart storage: write result tables idempotently, read them back.

``write_mart`` selects the mart's columns by name, casts them to the stored
schema, adds the audit column, and overwrites by default (re-running the
batch leaves the marts unchanged). Marts with a ``group_type`` column are
partitioned by it so a serving query for one group type reads one folder.
The row count comes from ``observe()`` on the write itself, not a second job.
Parquet is the default; ``fmt="jdbc"`` writes to any JDBC database.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from blotter.schemas import AUDIT_COLUMNS, MARTS
from blotter.session import put_path


def conform(df: DataFrame, name: str, audit: bool = True) -> DataFrame:
    """Columns of the stored schema, in order and type (+ audit timestamp)."""
    schema = MARTS[name]
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    if audit and name in AUDIT_COLUMNS:
        cols.append(F.current_timestamp().cast("timestamp_ntz").alias(AUDIT_COLUMNS[name]))
    return df.select(*cols)


def write_mart(df: DataFrame, name: str, base: str, mode: str = "overwrite", fmt: str = "parquet",
               audit: bool = True, jdbc_url: str | None = None, jdbc_props: dict | None = None, run_id: str | None = None) -> int:
    """Write one mart; returns the number of rows written.

    An overwrite of files is written aside and takes the old mart's place when
    it is complete, so a failed job leaves the old one. An append under a
    ``run_id`` can be repeated: the run's rows are a folder of their own (and
    ``run_id`` a column when read), put in place in the same way, so writing a
    run twice leaves its rows once and other runs alone. A mart is appended to
    either with run ids or without.
    """
    if run_id is not None and (mode != "append" or fmt == "jdbc"):
        raise ValueError("run_id goes with mode='append' and files")
    out = conform(df, name, audit)
    obs = Observation(f"write_{name}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    if fmt == "jdbc":
        # overwrite by TRUNCATE keeps the table's own DDL (ids, defaults, indexes)
        props = {"truncate": "true", **(jdbc_props or {})}
        out.write.jdbc(url=jdbc_url, table=name, mode=mode, properties=props)
    else:
        w = out.write.mode(mode).format(fmt)
        if "group_type" in out.columns:
            w = w.partitionBy("group_type")
        target = f"{base.rstrip('/')}/{name}"
        if run_id is not None:
            target = f"{target}/run_id={quote(run_id, safe='')}"
        if mode == "overwrite" or run_id is not None:
            aside = f"{base.rstrip('/')}/_{name}-{uuid.uuid4().hex[:12]}"
            w.mode("overwrite").save(aside)
            put_path(df.sparkSession, aside, target)
        else:
            w.save(target)
    return int(obs.get.get("rows", 0))


def is_absent(e: AnalysisException) -> bool:
    """Whether the error says that the path or table is not there (any other is the caller's to see)."""
    return (e.getCondition() or "").split(".")[0] in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def read_mart(spark: SparkSession, name: str, base: str, fmt: str = "parquet",
              jdbc_url: str | None = None, jdbc_props: dict | None = None) -> DataFrame:
    """Read a mart in its stored column order; an absent mart reads as empty."""
    schema = MARTS[name]
    try:
        if fmt == "jdbc":
            df = spark.read.jdbc(url=jdbc_url, table=name, properties=jdbc_props or {})
        else:
            df = spark.read.format(fmt).load(f"{base.rstrip('/')}/{name}")
        extra = [c for c in df.columns if c not in schema.fieldNames()]
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], *extra)
    except AnalysisException as e:
        if not is_absent(e):
            raise
        return spark.createDataFrame([], schema)


_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


#: Reader and writer options of alert documents: timestamps with full microseconds.
ALERT_DOC_OPTIONS = {"timestampNTZFormat": _TS_FORMAT, "timestampFormat": _TS_FORMAT + "XXX"}


def write_alert_docs(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Alert documents as JSON lines (timestamps with full microseconds)."""
    alerts.write.mode(mode).options(**ALERT_DOC_OPTIONS).json(path)


def read_alert_docs(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MARTS["alerts"]).options(**ALERT_DOC_OPTIONS).json(path)
    except AnalysisException as e:
        if not is_absent(e):
            raise
        return spark.createDataFrame([], MARTS["alerts"])


def latest_alert_docs(docs: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` alert documents."""
    return docs.orderBy(F.col("timestamp").desc(), F.col("district").asc(),
                        F.col("event_count").desc()).limit(n)
