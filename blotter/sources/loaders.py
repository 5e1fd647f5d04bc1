"""Typed CSV loaders for the five inputs.

Read policy (default): every column is read as a string with the header
skipped and columns bound by position, ``PERMISSIVE`` mode with a corrupt-record
column, and CSV column pruning off, so a row is judged on *all* its fields no
matter which columns a later query reads. Types are then applied with
``try_cast``; a row is rejected when the parser flagged it or when a present
value does not cast. ``mode="dropmalformed"`` reproduces Spark's own
DROPMALFORMED with the typed schema, whose verdict depends on the columns a
query touches.

``stage`` converts a CSV input to Parquet in one pass, partitioned by row
status (good / dropped / rejected), so the marts read a columnar,
pushdown-capable copy instead of re-parsing text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions import normalize_flag, parse_ts, presence_flag
from blotter.schemas import INPUTS, raw_schema, snake

CORRUPT = "_corrupt_record"
_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


def typed_schema(kind: str) -> T.StructType:
    cols, types = INPUTS[kind]
    return T.StructType([T.StructField(c, _TYPES[types.get(c, "string")], True) for c in cols])


def read_raw(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """All-string read with the corrupt-record column (policy above)."""
    cols, _ = INPUTS[kind]
    schema = raw_schema(cols).add(T.StructField(CORRUPT, T.StringType(), True))
    return (spark.read.schema(schema)
            .option("header", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", "false")
            .csv(path))


def apply_types(raw: DataFrame, kind: str) -> DataFrame:
    """Snake-case names, ``try_cast`` declared types, add ``_rejected``.

    ``raw`` has the input's original column names, all strings; the corrupt
    record column is optional (absent for rows that did not come from text).
    """
    return with_evidence(raw, kind).drop(*EVIDENCE)


#: What a rejected row keeps: the line the parser could not read, and the texts that failed their type, by column.
EVIDENCE = ("_raw_line", "_bad_values")


def with_evidence(raw: DataFrame, kind: str) -> DataFrame:
    """``apply_types`` with the ``EVIDENCE`` columns, NULL for good rows."""
    cols, types = INPUTS[kind]
    out, bad, texts = [], [], []
    for c in cols:
        t = types.get(c, "string")
        src = F.col(f"`{c}`")
        if t == "string":
            out.append(src.alias(snake(c)))
        else:
            typed = F.expr(f"try_cast(`{c}` AS {t.upper()})")
            out.append(typed.alias(snake(c)))
            bad.append(src.isNotNull() & typed.isNull())
            texts.append(F.when(bad[-1], F.struct(F.lit(snake(c)).alias("key"), src.alias("value"))))
    rejected, line = F.lit(False), F.lit(None).cast("string")
    if CORRUPT in raw.columns:
        rejected, line = F.col(CORRUPT).isNotNull(), F.col(CORRUPT)
    for b in bad:
        rejected = rejected | b
    values = F.map_from_entries(F.array_compact(F.array(*texts))) if texts else F.create_map().cast("map<string,string>")
    return raw.select(*out, rejected.alias("_rejected"), F.when(rejected, line).alias("_raw_line"), F.when(rejected, values).alias("_bad_values"))


def read_typed(spark: SparkSession, path: str, kind: str, mode: str = "permissive") -> DataFrame:
    """Typed rows of a CSV input (``_rejected`` rows removed)."""
    if mode.lower() == "dropmalformed":
        df = (spark.read.schema(typed_schema(kind)).option("header", "true")
              .option("mode", "DROPMALFORMED").csv(path))
        return df.toDF(*[snake(c) for c in df.columns])
    return apply_types(read_raw(spark, path, kind), kind).filter(~F.col("_rejected")).drop("_rejected")


def rejected_rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The rows the permissive policy rejects, with their ``EVIDENCE``: the raw line when the parser failed, the texts that failed their type."""
    return with_evidence(read_raw(spark, path, kind), kind).filter("_rejected").drop("_rejected")


# --- per-input preparation (typed, snake_case frame in, prepared frame out) --
# Each input has derived columns (DERIVE) and a row condition (KEEP); PREPARE
# applies both. Staging evaluates the condition instead of filtering, so
# dropped rows are kept aside in the same single pass.
def derive_incidents(df: DataFrame) -> DataFrame:
    """Parse the date, normalise the arrest flag."""
    return df.withColumn("ts", parse_ts("date")).withColumn("arrest", normalize_flag("arrest"))


def derive_arrests(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", parse_ts("arrest_date"))


def derive_violence(df: DataFrame) -> DataFrame:
    """Parse the date, normalise the gunshot flag, homicide = victim first name present."""
    return (df.withColumn("ts", parse_ts("date"))
            .withColumn("gunshot_injury_i", normalize_flag("gunshot_injury_i"))
            .withColumn("is_homicide", presence_flag("homicide_victim_first_name")))


def derive_registry(df: DataFrame) -> DataFrame:
    return df.withColumn("victim_minor", normalize_flag("victim_minor"))


DERIVE = {"incidents": derive_incidents, "stations": lambda df: df, "arrests": derive_arrests,
          "violence": derive_violence, "registry": derive_registry}
KEEP = {"incidents": lambda: F.col("case_number").isNotNull(),       # rows without a case number dropped
        "stations": lambda: F.col("district").isNotNull(),           # stations without a district dropped
        "arrests": lambda: F.col("case_number").isNotNull(),
        "violence": lambda: F.lit(True),
        "registry": lambda: F.lit(True)}


def _prepare(kind: str):
    return lambda df: DERIVE[kind](df).filter(KEEP[kind]())


PREPARE = {kind: _prepare(kind) for kind in DERIVE}
prepare_incidents, prepare_stations = PREPARE["incidents"], PREPARE["stations"]
prepare_arrests, prepare_violence = PREPARE["arrests"], PREPARE["violence"]
prepare_registry = PREPARE["registry"]


def load(spark: SparkSession, path: str, kind: str, mode: str = "permissive") -> DataFrame:
    """Read, type and prepare one input (the five ``load_*`` entry points)."""
    return PREPARE[kind](read_typed(spark, path, kind, mode))


def load_incidents(spark, path, mode="permissive"):
    return load(spark, path, "incidents", mode)


def load_stations(spark, path, mode="permissive"):
    return load(spark, path, "stations", mode)


def load_arrests(spark, path, mode="permissive"):
    return load(spark, path, "arrests", mode)


def load_violence(spark, path, mode="permissive"):
    return load(spark, path, "violence", mode)


def load_registry(spark, path, mode="permissive"):
    return load(spark, path, "registry", mode)


def stage(spark: SparkSession, path: str, kind: str, out_dir: str) -> dict:
    """CSV -> Parquet in one pass: ``{out_dir}/{kind}/_status=good|dropped|rejected``.

    The text is parsed once and written once, partitioned by row status:
    ``good`` (prepared rows), ``dropped`` (well-formed but failing the input's
    row condition) and ``rejected`` (malformed, with their ``EVIDENCE``).
    ``read_staged`` reads the rows of a status, also when there are none.
    """
    base = f"{out_dir.rstrip('/')}/{kind}"
    derived = DERIVE[kind](with_evidence(read_raw(spark, path, kind), kind))
    keep = KEEP[kind]()
    status = (F.when(F.col("_rejected"), F.lit("rejected"))
              .when(keep.isNull() | ~keep, F.lit("dropped")).otherwise(F.lit("good")))
    derived.withColumn("_status", status).drop("_rejected").write.mode("overwrite") \
        .partitionBy("_status").parquet(base)
    return {s: f"{base}/_status={s}" for s in ("good", "dropped", "rejected")}


def read_staged(spark: SparkSession, kind: str, out_dir: str, status: str = "good") -> DataFrame:
    """Staged rows of one status; the filter prunes to its folder, and a status without rows reads as empty."""
    layout = DERIVE[kind](with_evidence(spark.createDataFrame([], raw_schema(INPUTS[kind][0])), kind)).drop("_rejected")
    rows = spark.read.schema(layout.schema.add("_status", "string")).parquet(f"{out_dir.rstrip('/')}/{kind}")
    rows = rows.filter(F.col("_status") == status).drop("_status")
    return rows if status == "rejected" else rows.drop(*EVIDENCE)


def raw_frame(df: DataFrame, kind: str, values: dict[str, Column]) -> DataFrame:
    """Project ``df`` into an input's raw CSV layout (all strings; absent columns NULL)."""
    cols, _ = INPUTS[kind]
    return df.select(*[(values[c].cast("string") if c in values else F.lit(None).cast("string")).alias(c)
                       for c in cols])
