"""Cross-dataset relations: join per-key aggregates of two inputs.

Both join sides are aggregates, so each is at most one row per key. No
broadcast is forced: AQE sees the real post-aggregation sizes at runtime and
switches the sort-merge join to a broadcast hash join when one side is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``; a large key space keeps the
shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import normalize_key, rate
from blotter.operators.grouped import grouped_stats
from blotter.schemas import ARREST_FLAG, GT_COMMUNITY_AREA, GT_DISTRICT

CORR_COLUMNS = ["correlation_type", "group_key", "metric_1_name", "metric_1_value",
                "metric_2_name", "metric_2_value", "correlation_value"]

# Labels stored in the correlations table.
DISTRICT_TYPE = "violence_rate_vs_arrest_rate"
AREA_TYPE = "crime_count_vs_violence_count"
ARREST_RATE, CRIME_COUNT, VIOLENCE_COUNT = "arrest_rate", "crime_count", "violence_count"


def _key(c: str, normalize: bool):
    return normalize_key(c) if normalize else F.col(c)


def correlations(incidents: DataFrame, violence: DataFrame, normalize: bool = False,
                 dims: tuple[str, ...] = (GT_DISTRICT, GT_COMMUNITY_AREA)) -> DataFrame:
    """The correlations mart (``correlation_value`` stays NULL as in the stored table).

    One scan per input: each side is one aggregate over the wanted dimensions
    (GROUPING SETS for several), and the two are joined on (group_type, key).
    """
    keys = {d: _key(d, normalize) for d in dims}
    left = grouped_stats(incidents.select(*dims, "arrest"), keys,
                         {"crime_count": F.count(F.lit(1)),
                          "arrest_count": F.count_if(F.col("arrest") == ARREST_FLAG)})
    right = grouped_stats(violence.select(*dims), keys, {"violence_count": F.count(F.lit(1))})
    return correlation_rows(left.join(right, ["group_type", "group_value"], "inner"))


def corr_district(incidents: DataFrame, violence: DataFrame, normalize: bool = False) -> DataFrame:
    """Arrest rate vs violence count per district (inner join, NULL keys dropped)."""
    return correlations(incidents, violence, normalize, (GT_DISTRICT,))


def corr_area(incidents: DataFrame, violence: DataFrame, normalize: bool = False) -> DataFrame:
    """Incident count vs violence count per community area."""
    return correlations(incidents, violence, normalize, (GT_COMMUNITY_AREA,))


def correlation_rows(joined: DataFrame) -> DataFrame:
    """Stored shape from joined per-key counts: group_type (district / community_area),
    group_value, crime_count, arrest_count (district rows) and violence_count."""
    by_district = F.col("group_type") == GT_DISTRICT
    return joined.select(
        F.when(by_district, F.lit(DISTRICT_TYPE)).otherwise(F.lit(AREA_TYPE)).alias("correlation_type"),
        F.col("group_value").alias("group_key"),
        F.when(by_district, F.lit(ARREST_RATE)).otherwise(F.lit(CRIME_COUNT)).alias("metric_1_name"),
        F.when(by_district, rate("arrest_count", "crime_count", 4))
         .otherwise(F.col("crime_count").cast("double")).alias("metric_1_value"),
        F.lit(VIOLENCE_COUNT).alias("metric_2_name"),
        F.col("violence_count").cast("double").alias("metric_2_value"),
        F.lit(None).cast("double").alias("correlation_value"))


def unmatched_keys(incidents: DataFrame, violence: DataFrame, key: str = "district",
                   normalize: bool = False) -> DataFrame:
    """Keys present on one side only (full outer join of the distinct keys).

    A padded code ('001' vs '1') silently empties an inner join; this shows it.
    """
    a = incidents.filter(F.col(key).isNotNull()).select(_key(key, normalize).alias("k")).distinct()
    b = violence.filter(F.col(key).isNotNull()).select(_key(key, normalize).alias("k")).distinct()
    j = a.withColumn("in_incidents", F.lit(True)).join(
        b.withColumn("in_violence", F.lit(True)), "k", "full_outer")
    return j.filter(F.col("in_incidents").isNull() | F.col("in_violence").isNull()).select(
        F.col("k").alias(key), F.coalesce("in_incidents", F.lit(False)).alias("in_incidents"),
        F.coalesce("in_violence", F.lit(False)).alias("in_violence"))


def corr_summary(corr: DataFrame) -> DataFrame:
    """Per correlation type: label, n, Pearson r and the OLS line metric_2 ~ metric_1.

    One grouped aggregate (``corr`` / ``regr_*``) replaces a loop over the
    distinct types; values are rounded to 6 places.
    """
    from blotter.functions import title_label
    x, y = F.col("metric_1_value"), F.col("metric_2_value")
    return corr.groupBy("correlation_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.corr(x, y), 6).alias("pearson_r"),
        F.round(F.regr_slope(y, x), 6).alias("slope"),
        F.round(F.regr_intercept(y, x), 6).alias("intercept"),
        F.round(F.regr_r2(y, x), 6).alias("r2"),
    ).withColumn("title", title_label("correlation_type"))
