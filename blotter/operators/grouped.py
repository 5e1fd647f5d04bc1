"""Long-form grouped statistics: one scan, many single-column groupings.

``grouped_stats`` replaces "one groupBy per dimension, then UNION ALL" (one
scan per dimension) by a single ``GROUPING SETS`` aggregate. Catalyst plans
it as Expand -> partial HashAggregate -> Exchange -> final HashAggregate, so
the input is read once and only partial aggregates are shuffled. Each output
row is labelled from ``grouping()`` bits, never from which column is NULL: a
NULL group is a legal result for some dimensions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_stats(df: DataFrame, dims: Mapping[str, Column | str], aggs: Mapping[str, Column],
                  keep_null: Iterable[str] = ()) -> DataFrame:
    """Aggregate ``df`` per dimension and stack the results.

    dims: ``{group_type label: key column}`` (plain columns or expressions).
    aggs: ``{output name: aggregate column}``.
    keep_null: labels whose NULL key stays as a group (others drop it).
    Output: ``group_type, group_value`` (key cast to string), then the aggregates.
    """
    agg_names = list(aggs)
    aggs = [c.alias(n) for n, c in aggs.items()]
    keep = set(keep_null)
    labels = list(dims)
    keys = [f"__k{i}" for i in range(len(labels))]
    narrow = df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k)
                         for k, v in zip(keys, dims.values())], *df.columns)
    if len(keys) == 1:
        out = narrow.groupBy(keys[0]).agg(*aggs).select(
            F.lit(labels[0]).alias("group_type"), F.col(keys[0]).cast("string").alias("group_value"),
            *agg_names)
    else:
        flags = [f"__g{i}" for i in range(len(keys))]
        agg = narrow.groupingSets([[k] for k in keys], *keys).agg(
            *aggs, *[F.grouping(k).alias(g) for k, g in zip(keys, flags)])
        gtype = F.when(F.col(flags[0]) == 0, F.lit(labels[0]))
        gval = F.when(F.col(flags[0]) == 0, F.col(keys[0]).cast("string"))
        for lab, k, g in zip(labels[1:], keys[1:], flags[1:]):
            gtype = gtype.when(F.col(g) == 0, F.lit(lab))
            gval = gval.when(F.col(g) == 0, F.col(k).cast("string"))
        out = agg.select(gtype.alias("group_type"), gval.alias("group_value"), *agg_names)
    drop = [lab for lab in labels if lab not in keep]
    if drop:
        out = out.filter(F.col("group_value").isNotNull() | ~F.col("group_type").isin(drop))
    return out
