"""Scalar expressions shared by loaders, marts and the stream.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.schemas import TIMESTAMP_FORMAT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """12-hour text -> TIMESTAMP_NTZ (the wall clock as written); bad, empty or one-digit parts -> NULL.

    The text is parsed once, as UTC (a zone of the session would move times
    inside a daylight-saving gap) and without raising on bad text; the instant
    is then read back as that wall clock.
    """
    instant = F.try_to_timestamp(F.concat(_c(c), F.lit(" Z")), F.lit(f"{fmt} X"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def normalize_flag(c) -> Column:
    """' true ' -> 'TRUE': the flag columns are compared exactly after this."""
    return F.upper(F.trim(_c(c)))


def presence_flag(c) -> Column:
    """1 when the column has a value, else 0 (homicide = victim name present)."""
    return F.when(_c(c).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def calendar_parts(ts) -> dict[str, Column]:
    """year, month, day of week (1 = Sunday .. 7 = Saturday) and hour."""
    t = _c(ts)
    return {"year": F.year(t), "month": F.month(t),
            "day_of_week": F.dayofweek(t), "hour": F.hour(t)}


def rate(num, den, digits: int) -> Column:
    """round(num / den, digits) as double; NULL (not an error) when den is 0."""
    return F.round(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), digits)


def valid_coords(lat="latitude", lon="longitude") -> Column:
    """Both present and neither exactly 0.0."""
    la, lo = _c(lat), _c(lon)
    return la.isNotNull() & lo.isNotNull() & (la != 0.0) & (lo != 0.0)


def normalize_key(c) -> Column:
    """'  007 ' -> '7': optional join-key normalisation for padded codes.

    Keys that are not digit strings are only trimmed.
    """
    t = F.trim(_c(c))
    stripped = F.regexp_replace(t, r"^0+(?=\d)", "")
    return F.when(t.rlike(r"^\d+$"), stripped).otherwise(t)


# The display labels the dashboard uses.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
DAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def _label_map(labels: list[str]) -> Column:
    pairs = []
    for i, name in enumerate(labels, start=1):
        pairs += [F.lit(str(i)), F.lit(name)]
    return F.create_map(*pairs)


def month_name(c) -> Column:
    """'1' -> 'Jan' ... '12' -> 'Dec' (string key, as stored in the marts)."""
    return _label_map(MONTH_NAMES)[_c(c)]


def day_name(c) -> Column:
    """'1' -> 'Sun' ... '7' -> 'Sat'."""
    return _label_map(DAY_NAMES)[_c(c)]


def title_label(c) -> Column:
    """'violence_rate_vs_arrest_rate' -> 'Violence Rate Vs Arrest Rate'."""
    return F.initcap(F.regexp_replace(_c(c), "_", " "))
