"""The batch layer end to end: CSV inputs -> staged Parquet -> marts.

Each input is parsed once into a Parquet staging table (``loaders.stage``).
Then each input is scanned once for all the marts that need it: one
GROUPING SETS summary per input carries every single-dimension count the
marts use (incidents: four calendar parts, type, district, area; violence:
month, district, area). The summaries are a few thousand rows; they are
persisted and every mart is a filter/projection/join of them, so no mart
rescans its input (if an executor holding a cached block is lost, Spark
recomputes it from the one scan). Nothing passes through the driver except
the row counts observed on the writes and the k K-Means centroids.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions import calendar_parts, rate
from blotter.operators.grouped import grouped_stats
from blotter.plans import arrests as AR
from blotter.plans import correlation as CO
from blotter.plans import hotspots as HS
from blotter.plans import registry as RG
from blotter.plans import trends as TR
from blotter.plans import violence as VI
from blotter.sources import loaders as LD
from blotter.schemas import GT_COMMUNITY_AREA, GT_CRIME_TYPE, GT_DISTRICT
from blotter.sources import marts as MT


def incident_summary(incidents: DataFrame) -> DataFrame:
    """(group_type, group_value, crime_count, arrest_count) for every incident dimension, one scan."""
    parts = calendar_parts("ts")
    dims = {**{d: parts[d] for d in TR.TREND_DIMS}, GT_CRIME_TYPE: "primary_type", GT_DISTRICT: "district",
            GT_COMMUNITY_AREA: "community_area"}
    return grouped_stats(incidents.select("ts", "primary_type", "district", "community_area", "arrest"), dims,
                         {"crime_count": F.count(F.lit(1)),
                          "arrest_count": F.count_if(F.col("arrest") == AR.ARREST_FLAG)},
                         keep_null=[GT_CRIME_TYPE])


def violence_summary(violence: DataFrame) -> DataFrame:
    """The violence_stats rows (month, district, area), one scan."""
    return VI.violence_stats(violence)


def marts_from_summaries(inc_sum: DataFrame | None, vio_sum: DataFrame | None,
                         arrests: DataFrame | None) -> dict[str, DataFrame]:
    """Trends, arrest rates, correlations and violence stats derived from the two summaries."""
    out: dict[str, DataFrame] = {}
    if inc_sum is not None:
        out["crime_trends"] = (inc_sum.filter(F.col("group_type").isin(*TR.TREND_DIMS))
                               .select("group_type", "group_value", "crime_count"))
        if arrests is not None:
            rates = (inc_sum.filter(F.col("group_type").isin(GT_CRIME_TYPE, GT_DISTRICT))
                     .select("group_type", "group_value", F.col("crime_count").alias("total_crimes"),
                             F.col("arrest_count").alias("total_arrests"),
                             rate("arrest_count", "crime_count", 4).alias("arrest_rate")))
            # every incident is in exactly one crime_type group (NULL type kept)
            total = (inc_sum.filter(F.col("group_type") == GT_CRIME_TYPE)
                     .agg(F.coalesce(F.sum("crime_count"), F.lit(0)).cast("bigint")).scalar())
            out["arrest_rates"] = rates.unionByName(AR.arrest_rate_race(None, arrests, total))
    if vio_sum is not None:
        out["violence_stats"] = vio_sum
    if inc_sum is not None and vio_sum is not None:
        left = inc_sum.filter(F.col("group_type").isin(GT_DISTRICT, GT_COMMUNITY_AREA))
        right = (vio_sum.filter(F.col("group_type").isin(GT_DISTRICT, GT_COMMUNITY_AREA))
                 .select("group_type", "group_value", F.col("total_incidents").alias("violence_count")))
        out["correlations"] = CO.correlation_rows(left.join(right, ["group_type", "group_value"]))
    return out


def run_batch(spark: SparkSession, csv_paths: dict[str, str], out_dir: str, fmt: str = "parquet",
              k: int = 10, seed: int = 42, max_iter: int = 20, **jdbc) -> dict[str, int]:
    """Stage the CSV inputs, compute and write every mart; returns rows written per mart.

    ``csv_paths`` maps input kind (incidents, arrests, violence, registry,
    stations) to a CSV path; a missing kind skips the marts that need it.
    """
    stage_dir = f"{out_dir.rstrip('/')}/_staged"
    for kind, path in csv_paths.items():
        LD.stage(spark, path, kind, stage_dir)
    staged = {kind: LD.read_staged(spark, kind, stage_dir) for kind in csv_paths}
    inc, vio = staged.get("incidents"), staged.get("violence")
    inc_sum = incident_summary(inc).persist(StorageLevel.MEMORY_AND_DISK) if inc is not None else None
    vio_sum = violence_summary(vio).persist(StorageLevel.MEMORY_AND_DISK) if vio is not None else None
    written: dict[str, int] = {}
    try:
        for name, df in marts_from_summaries(inc_sum, vio_sum, staged.get("arrests")).items():
            written[name] = MT.write_mart(df, name, out_dir, fmt=fmt, **jdbc)
        if inc is not None:
            hs, _ = HS.detect_hotspots(inc.select("id", "latitude", "longitude"), k=k, seed=seed,
                                       max_iter=max_iter)
            written["hotspots"] = MT.write_mart(hs, "hotspots", out_dir, fmt=fmt, **jdbc)
        if "registry" in staged:
            written["sex_offender_stats"] = MT.write_mart(RG.registry_stats(staged["registry"]),
                                                          "sex_offender_stats", out_dir, fmt=fmt, **jdbc)
    finally:
        for s in (inc_sum, vio_sum):
            if s is not None:
                s.unpersist()
    return written
