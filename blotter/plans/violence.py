"""Violence statistics by month, district and community area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import rate
from blotter.operators.grouped import grouped_stats
from blotter.schemas import GT_COMMUNITY_AREA, GT_DISTRICT, GT_MONTH, YES_FLAG

VIOLENCE_DIMS = {GT_MONTH: "month", GT_DISTRICT: "district", GT_COMMUNITY_AREA: "community_area"}


def _aggs() -> dict:
    return {
        "total_incidents": F.count(F.lit(1)),
        "homicides": F.sum("is_homicide").cast("bigint"),
        "non_fatal_shootings": F.sum(F.when(F.col("is_homicide") == 0, 1).otherwise(0)).cast("bigint"),
        "gunshot_injuries": F.sum(F.when(F.col("gunshot_injury_i") == YES_FLAG, 1).otherwise(0)).cast("bigint"),
    }


def _with_prop(df: DataFrame) -> DataFrame:
    return df.withColumn("gunshot_proportion", rate("gunshot_injuries", "total_incidents", 4))


def violence_by(violence: DataFrame, label: str) -> DataFrame:
    return _with_prop(grouped_stats(violence, {label: VIOLENCE_DIMS[label]}, _aggs()))


def violence_stats(violence: DataFrame) -> DataFrame:
    """The violence_stats mart: all three dimensions from one scan, NULL keys dropped."""
    cols = list(VIOLENCE_DIMS.values()) + ["is_homicide", "gunshot_injury_i"]
    return _with_prop(grouped_stats(violence.select(*cols), VIOLENCE_DIMS, _aggs()))
