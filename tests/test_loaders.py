"""Typed CSV loading on hand-made edge-case rows (see FIXTURES.md)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tests.conftest import FIXTURES

from blotter.functions import normalize_key, parse_ts
from blotter.sources import loaders as LD

CSV = os.path.join(FIXTURES, "incidents.csv")


def test_reject_policy_does_not_depend_on_projection(spark):
    typed = LD.read_typed(spark, CSV, "incidents")
    assert typed.count() == 6
    assert typed.select("case_number").count() == 6
    assert typed.select("case_number", "latitude").count() == 6
    assert len(typed.collect()) == 6


def test_bad_double_and_extra_field_are_rejected(spark):
    rej = LD.rejected_rows(spark, CSV, "incidents")
    assert sorted(r.id for r in rej.collect()) == ["5", "6"]


def test_dropmalformed_parity_depends_on_columns(spark):
    d = LD.read_typed(spark, CSV, "incidents", mode="dropmalformed")
    assert len(d.collect()) == 6          # all columns parsed: both bad rows dropped
    assert d.select("case_number").count() == 8   # pruned: nothing validated


def test_load_incidents_rules(spark):
    rows = {r.id: r for r in LD.load_incidents(spark, CSV).collect()}
    assert sorted(rows) == ["1", "2", "3", "7"]      # empty / "" case numbers dropped
    assert rows["1"].ts == dt.datetime(2020, 1, 2, 13, 5)
    assert rows["2"].ts == dt.datetime(2020, 1, 2, 0, 0)  # lower-case am, midnight
    assert rows["3"].ts is None                             # one-digit parts
    assert rows["7"].ts is None                             # impossible date
    assert rows["1"].arrest == "TRUE" and rows["3"].arrest == "TRUE"
    assert rows["7"].arrest is None
    assert rows["2"].primary_type is None and rows["2"].district is None


def test_parse_ts_never_raises_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", "True")
    df = spark.createDataFrame([("01/02/2020 01:05:00 PM",), ("bad",), ("",), (None,)], "s string")
    got = [r.t for r in df.select(parse_ts("s").alias("t")).collect()]
    assert got == [dt.datetime(2020, 1, 2, 13, 5), None, None, None]


def test_stage_writes_good_and_rejected(spark, scratch):
    out = LD.stage(spark, CSV, "incidents", scratch)
    assert spark.read.parquet(out["good"]).count() == 4
    assert spark.read.parquet(out["dropped"]).count() == 2       # empty and "" case numbers
    assert spark.read.parquet(out["rejected"]).count() == 2


def test_normalize_key_matches_padded_codes(spark):
    df = spark.createDataFrame([("001",), ("1",), (" 010 ",), ("A01",), ("0",)], "k string")
    assert [r.n for r in df.select(normalize_key("k").alias("n")).collect()] == ["1", "1", "10", "A01", "0"]


def test_trend_of_loaded_rows_skips_missing_dates(spark):
    from blotter.plans.trends import incident_trends
    t = incident_trends(LD.load_incidents(spark, CSV))
    years = t.filter(F.col("group_type") == "year").collect()
    assert [(r.group_value, r.crime_count) for r in years] == [("2020", 2)]


def test_parse_ts_keeps_wall_clock_in_a_dst_gap(spark):
    df = spark.createDataFrame([("03/10/2024 02:30:00 AM",), ("13/40/2024 01:00:00 PM",), ("1/2/2020 1:05:00 PM",)],
                               "s string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        got = [r.t for r in df.select(parse_ts("s").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [dt.datetime(2024, 3, 10, 2, 30), None, None]


def test_rejected_rows_keep_the_evidence(spark):
    rows = LD.rejected_rows(spark, CSV, "incidents").collect()
    assert any(r["_raw_line"] for r in rows)                                # the parser failed: the line as it was
    bad = [r["_bad_values"] for r in rows if r["_bad_values"]]
    assert bad and all(v for m in bad for v in m.values())                  # a cast failed: the text as it was


def test_staging_without_a_good_row(spark, scratch):
    path = f"{scratch}/in"
    spark.createDataFrame([("1", "not a year")], "a string, b string").selectExpr(
        *[("'x'" if c != "Year" else "'not a year'") + f" AS `{c}`" for c in LD.INPUTS["incidents"][0]]).write.option("header", "true").csv(path)
    LD.stage(spark, path, "incidents", f"{scratch}/staged")
    assert LD.read_staged(spark, "incidents", f"{scratch}/staged").count() == 0
    bad = LD.read_staged(spark, "incidents", f"{scratch}/staged", "rejected").collect()
    assert len(bad) == 1 and bad[0]["_bad_values"]["year"] == "not a year"
