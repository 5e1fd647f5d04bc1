"""Registry statistics: overall summary row plus a row per gender."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.schemas import ALL_LABEL, YES_FLAG

MINOR_FLAG = YES_FLAG


def _aggs():
    return [F.count(F.lit(1)).alias("offender_count"),
            F.count_if(F.col("victim_minor") == MINOR_FLAG).alias("minor_victim_count")]


def registry_summary(registry: DataFrame) -> DataFrame:
    """One row labelled 'all'; proportion guarded to 0.0 for an empty table."""
    return registry.agg(*_aggs()).select(
        F.lit(ALL_LABEL).alias("district"), "offender_count", "minor_victim_count",
        F.round(F.col("minor_victim_count") / F.greatest(F.col("offender_count"), F.lit(1)), 4)
         .alias("minor_victim_proportion"))


def registry_by_gender(registry: DataFrame) -> DataFrame:
    """Per gender, the NULL gender kept as its own group."""
    return registry.groupBy("gender").agg(*_aggs()).select(
        F.col("gender").alias("district"), "offender_count", "minor_victim_count",
        F.round(F.col("minor_victim_count") / F.col("offender_count"), 4).alias("minor_victim_proportion"))


def registry_stats(registry: DataFrame) -> DataFrame:
    """Summary row + per-gender rows from one scan.

    The per-gender aggregate is computed once; the 'all' row is a global
    aggregate over those few rows (so an empty table still yields it, with
    0 / 0.0), and Spark reuses the shared exchange instead of rescanning.
    """
    by_gender = registry.select("gender", "victim_minor").groupBy("gender").agg(*_aggs())
    total = by_gender.agg(
        F.coalesce(F.sum("offender_count"), F.lit(0)).cast("bigint").alias("offender_count"),
        F.coalesce(F.sum("minor_victim_count"), F.lit(0)).cast("bigint").alias("minor_victim_count"),
    ).select(F.lit(ALL_LABEL).alias("district"), "offender_count", "minor_victim_count")
    rows = total.unionByName(by_gender.withColumnRenamed("gender", "district"))
    return rows.withColumn(
        "minor_victim_proportion",
        F.round(F.col("minor_victim_count") / F.greatest(F.col("offender_count"), F.lit(1)), 4))


def priority_records(registry: DataFrame) -> DataFrame:
    """Records whose victim was a minor."""
    return registry.filter(F.col("victim_minor") == MINOR_FLAG)
