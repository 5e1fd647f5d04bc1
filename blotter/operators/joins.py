"""Equi-joins whose left keys may be hot.

A key that holds more than 1/``HOT_SHARE`` of the left rows is dealt to several
tasks by a salt, and the right rows of that key are repeated once per salt. At
most ``HOT_SHARE`` keys can be that hot, whatever the input, so their salts are
a literal in the plan; all other keys join as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 256


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> dict[int, int]:
    """{key: tasks it is dealt to} of the integer keys with more than 1/share of the rows."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    hot = sizes.withColumn("__all", total).where(F.col("__n") * share > F.col("__all"))
    return {r[key]: -(-r["__n"] * share // r["__all"]) for r in hot.collect()}


def tasks_of(key: str, hot: dict[int, int]) -> Column:
    """Tasks that the rows of a key are dealt to."""
    n = F.lit(1)
    for k, tasks in hot.items():
        n = F.when(F.col(key) == k, tasks).otherwise(n)
    return n.cast("int")


def spread_join(left: DataFrame, right: DataFrame, key: str, by: str, share: int = HOT_SHARE) -> DataFrame:
    """Inner join on the integer column ``key``; ``by`` is a left column that tells a hot key's rows apart."""
    hot = hot_keys(left, key, share)
    if not hot:
        return left.join(right, key)
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(by), tasks_of(key, hot)).cast("int"))
    dealt = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), tasks_of(key, hot) - 1)))
    return salted.join(dealt, [key, "__salt"]).drop("__salt")
