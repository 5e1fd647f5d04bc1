"""Arrest rates by incident type, district, community area, and arrests by race."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import rate
from blotter.operators.grouped import grouped_stats
from blotter.schemas import ARREST_FLAG, GT_COMMUNITY_AREA, GT_CRIME_TYPE, GT_DISTRICT, GT_RACE


def _arrest_aggs() -> dict:
    return {"total_crimes": F.count(F.lit(1)),
            "total_arrests": F.count_if(F.col("arrest") == ARREST_FLAG)}


def _with_rate(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumn("arrest_rate", rate("total_arrests", "total_crimes", digits))


def arrest_rate_by(incidents: DataFrame, label: str, key: str, keep_null: bool) -> DataFrame:
    """Conditional count over one key; NULL flags count only in the denominator."""
    out = grouped_stats(incidents, {label: key}, _arrest_aggs(), keep_null=[label] if keep_null else [])
    return _with_rate(out)


def arrest_rate_type(incidents: DataFrame) -> DataFrame:
    return arrest_rate_by(incidents, GT_CRIME_TYPE, "primary_type", keep_null=True)


def arrest_rate_district(incidents: DataFrame) -> DataFrame:
    return arrest_rate_by(incidents, GT_DISTRICT, "district", keep_null=False)


def arrest_rate_area(incidents: DataFrame) -> DataFrame:
    return arrest_rate_by(incidents, GT_COMMUNITY_AREA, "community_area", keep_null=False)


def arrest_rate_race(incidents: DataFrame | None, arrests: DataFrame, total=None) -> DataFrame:
    """Arrests per race over the count of *all* incidents (rounded to 6 places).

    The grand total is a scalar subquery: Spark runs it once as its own small
    job and inlines the value, so there is no join and no driver round trip.
    ``total`` may pass an already computed total (a scalar Column); then
    ``incidents`` is not read and may be None.
    """
    if total is None:
        total = incidents.agg(F.count(F.lit(1))).scalar()
    by_race = arrests.filter(F.col("race").isNotNull()).groupBy("race").agg(
        F.count(F.lit(1)).alias("total_arrests"))
    return by_race.select(
        F.lit(GT_RACE).alias("group_type"), F.col("race").alias("group_value"),
        total.alias("total_crimes"), "total_arrests",
    ).withColumn("arrest_rate", rate("total_arrests", "total_crimes", 6))


def arrest_rates(incidents: DataFrame, arrests: DataFrame, with_area: bool = False) -> DataFrame:
    """The arrest_rates mart: type (NULL kept) + district (+ area) in one pass, plus race."""
    dims = {GT_CRIME_TYPE: "primary_type", GT_DISTRICT: "district"}
    if with_area:
        dims[GT_COMMUNITY_AREA] = "community_area"
    grouped = _with_rate(grouped_stats(incidents.select(*set(dims.values()), "arrest"), dims,
                                       _arrest_aggs(), keep_null=[GT_CRIME_TYPE]))
    return grouped.unionByName(arrest_rate_race(incidents, arrests))
