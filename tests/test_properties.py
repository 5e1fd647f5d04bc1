"""Property checks on the marts and on grouped_stats."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL

from blotter.operators.grouped import grouped_stats
from blotter.plans import arrests as AR
from blotter.plans import trends as TR
from blotter.sources import testtables as TT


def test_each_trend_type_sums_to_dated_rows(spark):
    inc = TT.incidents(spark, SMALL)
    dated = inc.filter(F.col("ts").isNotNull()).count()
    sums = {r.group_type: r.n for r in TR.incident_trends(inc).groupBy("group_type")
            .agg(F.sum("crime_count").alias("n")).collect()}
    assert sums == {"year": dated, "month": dated, "day_of_week": dated, "hour": dated}


def test_rates_in_unit_interval_and_counts_consistent(spark):
    inc, arr = TT.incidents(spark, SMALL), TT.arrests(spark, SMALL)
    rows = AR.arrest_rates(inc, arr, with_area=True).collect()
    n = inc.count()
    for r in rows:
        if r.group_type != "race":
            assert 0.0 <= r.arrest_rate <= 1.0 and r.total_arrests <= r.total_crimes
        else:
            assert r.total_crimes == n
    assert sum(r.total_crimes for r in rows if r.group_type == "crime_type") == n


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, 3, None]),
              st.integers(min_value=0, max_value=5)),
    min_size=0, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_grouped_stats_equals_per_dimension_groupby(spark, rows):
    df = spark.createDataFrame(rows, "k1 string, k2 int, v int")
    out = grouped_stats(df, {"first": "k1", "second": "k2"},
                        {"n": F.count(F.lit(1)), "s": F.sum("v")}, keep_null=["first"])
    got = Counter((r.group_type, r.group_value, r.n, r.s) for r in out.collect())
    want = Counter()
    for label, idx, keep in (("first", 0, True), ("second", 1, False)):
        groups = {}
        for row in rows:
            groups.setdefault(row[idx], []).append(row[2])
        for key, vals in groups.items():
            if key is None and not keep:
                continue
            want[(label, None if key is None else str(key), len(vals), sum(vals))] += 1
    assert got == want
