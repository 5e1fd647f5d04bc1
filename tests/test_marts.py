"""Mart rules: NULL groups, zero denominators, idempotent storage, pruning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL

from blotter.plans import arrests as AR
from blotter.plans import registry as RG
from blotter.plans import violence as VI
from blotter.sources import marts as MT
from blotter.sources import testtables as TT

INC = "id long, case_number string, ts timestamp_ntz, primary_type string, district string, community_area string, arrest string"


def test_empty_inputs_give_null_rates_and_zero_proportion(spark):
    inc = spark.createDataFrame([], INC)
    arr = spark.createDataFrame([("1", dt.datetime(2020, 1, 1), "W")], "case_number string, ts timestamp_ntz, race string")
    race = AR.arrest_rate_race(inc, arr).collect()
    assert race[0].total_crimes == 0 and race[0].arrest_rate is None
    reg = RG.registry_stats(spark.createDataFrame([], "gender string, victim_minor string")).collect()
    assert [(r.district, r.offender_count, r.minor_victim_proportion) for r in reg] == [("all", 0, 0.0)]


def test_null_type_kept_null_district_dropped(spark):
    rows = [(1, "c1", None, None, None, "1", "TRUE"), (2, "c2", None, "T", "5", "1", "FALSE")]
    out = AR.arrest_rates(spark.createDataFrame(rows, INC), spark.createDataFrame([], "case_number string, ts timestamp_ntz, race string"))
    got = {(r.group_type, r.group_value): (r.total_crimes, r.total_arrests) for r in out.collect()}
    assert got == {("crime_type", None): (1, 1), ("crime_type", "T"): (1, 0), ("district", "5"): (1, 0)}


def test_registry_total_and_null_gender_are_distinct(spark):
    reg = spark.createDataFrame([(None, "Y"), ("M", "N"), ("M", "Y")], "gender string, victim_minor string")
    got = {r.district: (r.offender_count, r.minor_victim_count) for r in RG.registry_stats(reg).collect()}
    assert got == {"all": (3, 2), None: (1, 1), "M": (2, 1)}


def test_violence_properties(spark):
    v = VI.violence_stats(TT.violence(spark, SMALL)).collect()
    for r in v:
        assert r.homicides + r.non_fatal_shootings == r.total_incidents
        assert 0.0 <= r.gunshot_proportion <= 1.0
    total = TT.violence(spark, SMALL).count()
    for gt in ("month", "district", "community_area"):
        assert sum(r.total_incidents for r in v if r.group_type == gt) == total


def test_write_twice_is_idempotent_and_pruned(spark, scratch):
    df = VI.violence_stats(TT.violence(spark, SMALL))
    n1 = MT.write_mart(df, "violence_stats", scratch)
    n2 = MT.write_mart(df, "violence_stats", scratch)
    back = MT.read_mart(spark, "violence_stats", scratch)
    assert n1 == n2 == back.count() == df.count()
    one = back.filter(F.col("group_type") == "district")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(group_type" in plan


def test_absent_mart_reads_empty(spark, scratch):
    df = MT.read_mart(spark, "hotspots", f"{scratch}/nothing-here")
    assert df.count() == 0 and df.columns == ["cluster_id", "latitude", "longitude", "crime_count"]


def test_jdbc_roundtrip_with_embedded_derby(spark):
    url = "jdbc:derby:memory:blotter;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = RG.registry_stats(TT.registry(spark, SMALL))
    try:
        n = MT.write_mart(df, "sex_offender_stats", "", fmt="jdbc", jdbc_url=url, jdbc_props=props)
    except Exception as e:  # noqa: BLE001
        import pytest
        pytest.skip(f"no embedded JDBC driver: {type(e).__name__}")
    back = MT.read_mart(spark, "sex_offender_stats", "", fmt="jdbc", jdbc_url=url, jdbc_props=props)
    assert n == back.count() == df.count()
    n2 = MT.write_mart(df, "sex_offender_stats", "", fmt="jdbc", jdbc_url=url, jdbc_props=props)  # truncate
    again = MT.read_mart(spark, "sex_offender_stats", "", fmt="jdbc", jdbc_url=url, jdbc_props=props)
    assert n2 == again.count() == df.count()


def test_padded_keys_need_normalisation(spark):
    from blotter.plans.correlation import correlations, unmatched_keys
    inc = spark.createDataFrame([(1, "c1", None, "T", "001", "7", "TRUE")], INC)
    vio = spark.createDataFrame([("1", "1", "07", 0, "Y")],
                                "month string, district string, community_area string, is_homicide int, gunshot_injury_i string")
    assert correlations(inc, vio).count() == 0
    assert {r.district for r in unmatched_keys(inc, vio).collect()} == {"001", "1"}
    got = {(r.correlation_type, r.group_key) for r in correlations(inc, vio, normalize=True).collect()}
    assert got == {("violence_rate_vs_arrest_rate", "1"), ("crime_count_vs_violence_count", "7")}
    assert unmatched_keys(inc, vio, normalize=True).count() == 0


def test_mart_slice_sorts_for_display(spark):
    from blotter.plans.serving import mart_slice
    from blotter.plans.trends import incident_trends
    t = incident_trends(TT.incidents(spark, SMALL))
    hours = [r.group_value for r in mart_slice(t, "hour", numeric=True).collect()]
    assert hours == [str(h) for h in sorted(int(h) for h in hours)]
    by_count = [r.crime_count for r in mart_slice(t, "hour", "crime_count", descending=True).collect()]
    assert by_count == sorted(by_count, reverse=True)


def test_a_mart_with_other_columns_is_an_error(spark, scratch):
    import pytest
    from pyspark.errors import AnalysisException
    spark.range(3).write.parquet(f"{scratch}/hotspots")
    with pytest.raises(AnalysisException):
        MT.read_mart(spark, "hotspots", scratch)


def test_a_failed_overwrite_leaves_the_old_mart(spark, scratch):
    import pytest
    from blotter.plans import violence as VI
    good = VI.violence_stats(TT.violence(spark, SMALL))
    n = MT.write_mart(good, "violence_stats", scratch)
    bad = good.withColumn("homicides", F.when(F.col("group_type") == "month", F.raise_error(F.lit("broken"))).otherwise(F.col("homicides")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        MT.write_mart(bad, "violence_stats", scratch)
    assert MT.read_mart(spark, "violence_stats", scratch).count() == n


def test_a_repeated_run_is_appended_once(spark, scratch):
    """Also when the first attempt had other groups; other runs and odd run names stay apart."""
    from blotter.sources.marts import read_mart, write_mart
    rows = lambda *keys: spark.createDataFrame([("year", k, 1) for k in keys], "group_type string, group_value string, crime_count long")
    for run, keys in (("r1", ["1", "2", "3"]), ("r2/x y", ["9"]), ("r1", ["1", "2"]), ("r2/x y", ["9"])):
        write_mart(rows(*keys), "crime_trends", scratch, mode="append", run_id=run)
    got = sorted((r.run_id, r.group_value) for r in read_mart(spark, "crime_trends", scratch).collect())
    assert [v for _, v in got] == ["1", "2", "9"] and len({r for r, _ in got}) == 2
    with pytest.raises(ValueError):
        write_mart(rows("1"), "crime_trends", scratch, run_id="r1")
