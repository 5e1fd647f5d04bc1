"""Calendar trends: incident counts by year, month, day of week and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import calendar_parts
from blotter.operators.grouped import grouped_stats
from blotter.schemas import GT_DAY_OF_WEEK, GT_HOUR, GT_MONTH, GT_YEAR

TREND_DIMS = (GT_YEAR, GT_MONTH, GT_DAY_OF_WEEK, GT_HOUR)


def with_calendar_parts(incidents: DataFrame, ts: str = "ts") -> DataFrame:
    return incidents.withColumns(calendar_parts(ts))


def trend(incidents: DataFrame, part: str) -> DataFrame:
    """One calendar dimension: (group_type, group_value, crime_count), NULL keys dropped."""
    parts = calendar_parts("ts")
    return grouped_stats(incidents, {part: parts[part]}, {"crime_count": F.count(F.lit(1))})


def incident_trends(incidents: DataFrame, dims=TREND_DIMS) -> DataFrame:
    """All calendar dimensions in one pass; rows with no date are absent.

    The rows are counted by all parts together first, so the grouping sets
    expand those counts (a few thousand a year) and not the rows.
    """
    parts = calendar_parts("ts")
    cells = incidents.select(*[parts[d].alias(d) for d in dims]).groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))
    return grouped_stats(cells, {d: d for d in dims}, {"crime_count": F.sum("n")})
