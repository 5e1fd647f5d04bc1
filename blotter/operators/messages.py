"""Event messages: publish rows as JSON, parse and validate them back.

The message is a JSON object of string fields; validation requires the
required fields to be present and non-empty (missing, NULL and '' all fail).
Undecodable text parses to a struct of NULLs and is rejected like any other
record, with the missing fields listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.schemas import MESSAGE_FIELDS, REQUIRED_MESSAGE_FIELDS, TIMESTAMP_FORMAT, UNKNOWN_DISTRICT, message_schema, snake


def to_message(fields: Mapping[str, Column]) -> Column:
    """JSON text with every message field, absent ones as ''."""
    return F.to_json(F.struct(*[F.coalesce(fields.get(k, F.lit("")).cast("string"), F.lit("")).alias(k)
                                for k in MESSAGE_FIELDS]))


#: Column of a loaded incident for each message field.
INCIDENT_FIELDS = {"CASE NUMBER": "case_number", "DATE": "date", "BLOCK": "block", "PRIMARY TYPE": "primary_type", "DISTRICT": "district",
                   "ARREST": "arrest", "LATITUDE": "latitude", "LONGITUDE": "longitude", "DESCRIPTION": "description",
                   "COMMUNITY AREA": "community_area", "BEAT": "beat"}


def incident_fields(incidents: DataFrame) -> dict[str, Column]:
    """The message fields of loaded incidents; a field without a column is absent.

    DATE is the source text as it was read, parseable or not; only rows without
    that column get it from the parsed time.
    """
    cols = set(incidents.columns)
    fields = {f: F.col(c) for f, c in INCIDENT_FIELDS.items() if c in cols}
    if "date" not in cols and "ts" in cols:
        fields["DATE"] = F.date_format("ts", TIMESTAMP_FORMAT)
    return {"CASE NUMBER": F.lit(None), "DISTRICT": F.lit(None)} | fields


def publishable(fields: Mapping[str, Column]) -> Column:
    """Rows the producer sends: case number and district non-empty."""
    return ((F.length(F.coalesce(fields["CASE NUMBER"], F.lit(""))) > 0)
            & (F.length(F.coalesce(fields["DISTRICT"], F.lit(""))) > 0))


def parse_messages(df: DataFrame, value: str = "value", fields: Iterable[str] | None = None) -> DataFrame:
    """Add ``msg`` (struct of the message fields) parsed from JSON text.

    ``fields`` names the fields wanted beside the required ones (default: all);
    others are not parsed.

    The parse sits in a Generate (``inline`` of a one-element array): filters
    on its output cannot be pushed below it, so each message is parsed once.
    A plain projection would be inlined by predicate pushdown into the
    validation filter and the JSON parsed twice per row.
    """
    schema = message_schema()
    if fields is not None:
        wanted = {*REQUIRED_MESSAGE_FIELDS, *fields}
        schema = T.StructType([f for f in schema.fields if f.name in wanted])
    parsed = F.from_json(F.col(value).cast("string"), schema, {"mode": "PERMISSIVE"})
    return df.select("*", F.inline(F.array(F.struct(parsed.alias("msg")))))


def _missing(name: str) -> Column:
    return F.coalesce(F.col("msg").getField(name), F.lit("")) == F.lit("")


def with_validation(parsed: DataFrame, time: str = "ts") -> DataFrame:
    """Add ``valid`` (bool) and ``missing`` (comma list of failed required fields).

    A message whose arrival time (column ``time``, where there is one) is NULL
    cannot be counted and fails with ``time`` in the list.
    """
    flags = [F.when(_missing(n), F.lit(n)) for n in REQUIRED_MESSAGE_FIELDS]
    if time in parsed.columns:
        flags.append(F.when(F.col(time).isNull(), F.lit(time)))
    return parsed.withColumn("missing", F.concat_ws(",", *flags)).withColumn(
        "valid", F.col("missing") == F.lit(""))


def accepted(validated: DataFrame, keep=("id",)) -> DataFrame:
    """Valid messages flattened to snake_case columns (those that were parsed)."""
    parsed = validated.schema["msg"].dataType.fieldNames()
    return validated.filter("valid").select(
        *keep, *[F.col("msg").getField(n).alias(snake(n)) for n in MESSAGE_FIELDS if n in parsed])


def rejected(validated: DataFrame, keep=("id",), value: str = "value") -> DataFrame:
    return validated.filter(~F.col("valid")).select(*keep, value, "missing")


def route_key(c: Column | str = "district") -> Column:
    """District routing key with the 'UNKNOWN' default."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(UNKNOWN_DISTRICT))
