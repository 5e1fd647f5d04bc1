"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the provided tables (through ``blotter.sources.testtables``)
over their whole extent; the matching DuckDB SQL lives in ``blotter.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions import calendar_parts, normalize_flag, parse_ts
from blotter.operators import alerts as AL
from blotter.operators import messages as MS
from blotter.operators import windows as WO
from blotter.plans import arrests as AR
from blotter.plans import correlation as CO
from blotter.plans import hotspots as HS
from blotter.plans import registry as RG
from blotter.plans import serving as SV
from blotter.plans import trends as TR
from blotter.plans import violence as VI
from blotter.session import scratch_path
from blotter.sources import loaders as LD
from blotter.sources import marts as MT
from blotter.sources import testtables as TT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- calendar trends -------------------------------------------------------
@register("incident_trends")
def q_incident_trends(spark, d):
    return TR.incident_trends(TT.incidents(spark, d))


for _part, _key in [("year", "trend_year"), ("month", "trend_month"),
                    ("day_of_week", "trend_dow"), ("hour", "trend_hour")]:
    register(_key)(lambda spark, d, _p=_part: TR.trend(TT.incidents(spark, d), _p))


@register("incident_summary")
def q_incident_summary(spark, d):
    from blotter.plans.batch import incident_summary
    return incident_summary(TT.incidents(spark, d))


# --- arrest rates ----------------------------------------------------------
@register("arrest_rate_type")
def q_arrest_rate_type(spark, d):
    return AR.arrest_rate_type(TT.incidents(spark, d))


@register("arrest_rate_district")
def q_arrest_rate_district(spark, d):
    return AR.arrest_rate_district(TT.incidents(spark, d))


@register("arrest_rate_area")
def q_arrest_rate_area(spark, d):
    return AR.arrest_rate_area(TT.incidents(spark, d))


@register("arrest_rate_race")
def q_arrest_rate_race(spark, d):
    return AR.arrest_rate_race(TT.incidents(spark, d), TT.arrests(spark, d))


@register("arrest_rates")
def q_arrest_rates(spark, d):
    return AR.arrest_rates(TT.incidents(spark, d), TT.arrests(spark, d))


# --- violence --------------------------------------------------------------
@register("violence_month")
def q_violence_month(spark, d):
    return VI.violence_by(TT.violence(spark, d), "month")


@register("violence_district")
def q_violence_district(spark, d):
    return VI.violence_by(TT.violence(spark, d), "district")


@register("violence_area")
def q_violence_area(spark, d):
    return VI.violence_by(TT.violence(spark, d), "community_area")


@register("violence_stats")
def q_violence_stats(spark, d):
    return VI.violence_stats(TT.violence(spark, d))


# --- registry --------------------------------------------------------------
@register("registry_summary")
def q_registry_summary(spark, d):
    return RG.registry_summary(TT.registry(spark, d))


@register("registry_by_gender")
def q_registry_by_gender(spark, d):
    return RG.registry_by_gender(TT.registry(spark, d))


@register("registry_stats")
def q_registry_stats(spark, d):
    return RG.registry_stats(TT.registry(spark, d))


@register("priority_records")
def q_priority_records(spark, d):
    return RG.priority_records(TT.registry(spark, d))


# --- correlations ----------------------------------------------------------
@register("corr_district")
def q_corr_district(spark, d):
    return CO.corr_district(TT.incidents(spark, d), TT.violence(spark, d))


@register("corr_area")
def q_corr_area(spark, d):
    return CO.corr_area(TT.incidents(spark, d), TT.violence(spark, d))


@register("correlations")
def q_correlations(spark, d):
    return CO.correlations(TT.incidents(spark, d), TT.violence(spark, d))


@register("corr_summary")
def q_corr_summary(spark, d):
    return CO.corr_summary(CO.correlations(TT.incidents(spark, d), TT.violence(spark, d)))


# --- stream operators, batch form ------------------------------------------

WINDOW_SECONDS = 24 * 3600
WINDOW, SLIDE = "24 hours", "6 hours"
THRESHOLD = 10


def validated_messages(spark, d):
    return MS.with_validation(MS.parse_messages(TT.message_rows(spark, d)))


def accepted_events(spark, d):
    return MS.accepted(validated_messages(spark, d), keep=("id", "ts"))


def counted_events(spark, d):
    """Accepted events with what the window counts need; no other field is parsed."""
    parsed = MS.with_validation(MS.parse_messages(TT.message_rows(spark, d), fields=("DISTRICT",)))
    return MS.accepted(parsed, keep=("id", "ts")).select("id", "ts", "district")


def trailing_counts(spark, d):
    ev = counted_events(spark, d)
    return WO.trailing_count(ev, WINDOW_SECONDS, key="district", ts="ts", order="id")


def newest_alerts(spark, d, n):
    return SV.newest_first(counted_events(spark, d), n, WINDOW_SECONDS, THRESHOLD, clock=TT.message_rows(spark, d).select("ts"))


def alerts_mart(spark, d):
    return AL.alert_records(trailing_counts(spark, d), THRESHOLD)


def window_counts(spark, d):
    ev = counted_events(spark, d).select("ts", "district")
    return WO.sliding_counts(ev, WINDOW, SLIDE, key="district", ts="ts")


@register("validate_events")
def q_validate_events(spark, d):
    return accepted_events(spark, d)


@register("rejected_events")
def q_rejected_events(spark, d):
    return MS.rejected(validated_messages(spark, d), keep=("id",))


@register("route_key")
def q_route_key(spark, d):
    return accepted_events(spark, d).select("id", MS.route_key("district").alias("route_key"))


@register("events_to_json")
def q_events_to_json(spark, d):
    inc = TT.incidents(spark, d)
    fields = MS.incident_fields(inc)
    return inc.filter(MS.publishable(fields)).select("id", MS.to_message(fields).alias("value"))


@register("trailing_count")
def q_trailing_count(spark, d):
    return trailing_counts(spark, d)


@register("trailing_count_ranked")
def q_trailing_count_ranked(spark, d):
    """The earlier name of the position-based form, which is now the only one."""
    return trailing_counts(spark, d)


def tied_events(spark, d, copies):
    """Accepted events with times cut to the hour, each put down ``copies`` times under one id."""
    ev = counted_events(spark, d).select("id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "district")
    return ev if copies == 1 else ev.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")


@register("trailing_count_ties")
def q_trailing_count_ties(spark, d):
    return WO.trailing_count(tied_events(spark, d, 1), WINDOW_SECONDS, key="district", ts="ts", order="id")


@register("trailing_count_repeats")
def q_trailing_count_repeats(spark, d):
    return WO.trailing_count(tied_events(spark, d, 2), WINDOW_SECONDS, key="district", ts="ts", order="id")


@register("alerts")
def q_alerts(spark, d):
    return alerts_mart(spark, d)


@register("alerts_crossing")
def q_alerts_crossing(spark, d):
    counts = WO.trailing_count(counted_events(spark, d), WINDOW_SECONDS, key="district", ts="ts", order="id", position="position")
    return AL.alert_records(counts, THRESHOLD, alert_on="crossing", window_seconds=WINDOW_SECONDS, position="position")


@register("sliding_counts")
def q_sliding_counts(spark, d):
    return window_counts(spark, d)


@register("window_alerts")
def q_window_alerts(spark, d):
    return AL.window_alert_records(window_counts(spark, d), THRESHOLD)


@register("severity_mix")
def q_severity_mix(spark, d):
    return SV.severity_mix(newest_alerts(spark, d, 50), 50)


@register("recent_alerts")
def q_recent_alerts(spark, d):
    return newest_alerts(spark, d, 10)


@register("busiest_now")
def q_busiest_now(spark, d):
    return SV.busiest_now(counted_events(spark, d), WINDOW_SECONDS, 5)


# --- serving top-k and labels ----------------------------------------------
@register("top_types")
def q_top_types(spark, d):
    return SV.top_by(AR.arrest_rate_type(TT.incidents(spark, d)), "crime_type", "arrest_rate", 10)


@register("top_areas")
def q_top_areas(spark, d):
    return SV.top_by(VI.violence_by(TT.violence(spark, d), "community_area"),
                     "community_area", "total_incidents", 10)


@register("top15_types")
def q_top15_types(spark, d):
    return SV.top_by(AR.arrest_rate_type(TT.incidents(spark, d)), "crime_type", "arrest_rate", 15)


@register("top20_areas")
def q_top20_areas(spark, d):
    return SV.top_by(VI.violence_by(TT.violence(spark, d), "community_area"), "community_area", "total_incidents", 20)


@register("slice_hours")
def q_slice_hours(spark, d):
    return SV.ranked_slice(TR.trend(TT.incidents(spark, d), "hour"), "hour", numeric=True)


@register("slice_months")
def q_slice_months(spark, d):
    return SV.ranked_slice(TR.trend(TT.incidents(spark, d), "month"), "month", numeric=True)


@register("slice_district_rates")
def q_slice_district_rates(spark, d):
    return SV.ranked_slice(AR.arrest_rate_district(TT.incidents(spark, d)), "district", "arrest_rate", descending=True)


@register("slice_race_arrests")
def q_slice_race_arrests(spark, d):
    return SV.ranked_slice(AR.arrest_rate_race(TT.incidents(spark, d), TT.arrests(spark, d)), "race", "total_arrests", descending=True)


@register("slice_violence_months")
def q_slice_violence_months(spark, d):
    return SV.ranked_slice(VI.violence_by(TT.violence(spark, d), "month"), "month", numeric=True)


@register("trend_labels")
def q_trend_labels(spark, d):
    return SV.trend_labels(TR.incident_trends(TT.incidents(spark, d)))


# --- loaders: raw CSV-layout rows -> typed, prepared rows -------------------


def _loaded(kind, raw):
    typed = LD.apply_types(raw, kind)
    return LD.PREPARE[kind](typed.filter(~F.col("_rejected")).drop("_rejected"))


@register("load_incidents")
def q_load_incidents(spark, d):
    return _loaded("incidents", TT.raw_incidents(spark, d)).select(
        "id", "case_number", "date", "ts", "primary_type", "arrest", "district", "community_area",
        "year", "latitude", "longitude")


@register("load_arrests")
def q_load_arrests(spark, d):
    return _loaded("arrests", TT.raw_arrests(spark, d)).select(
        "cb_no", "case_number", "arrest_date", "ts", "race", "charge_1_statute")


@register("load_violence")
def q_load_violence(spark, d):
    return _loaded("violence", TT.raw_violence(spark, d)).select(
        "case_number", "date", "ts", "gunshot_injury_i", "is_homicide", "community_area", "district",
        "month", "latitude", "longitude")


@register("load_registry")
def q_load_registry(spark, d):
    return _loaded("registry", TT.raw_registry(spark, d)).select("last", "gender", "victim_minor")


@register("load_stations")
def q_load_stations(spark, d):
    return _loaded("stations", TT.raw_stations(spark, d)).select(
        "district", "district_name", "latitude", "longitude")


@register("rejected_rows")
def q_rejected_rows(spark, d):
    bad = LD.with_evidence(TT.raw_incidents(spark, d), "incidents").filter("_rejected")
    return bad.select(F.col("id").cast("bigint").alias("id"), F.explode("_bad_values").alias("field", "value"))


@register("parse_ts")
def q_parse_ts(spark, d):
    raw = TT.raw_incidents(spark, d).select(F.col("ID").cast("bigint").alias("id"), F.col("Date").alias("raw"))
    return raw.select("id", "raw", parse_ts("raw").alias("parsed"))


@register("normalize_flags")
def q_normalize_flags(spark, d):
    raw = TT.raw_incidents(spark, d).select(F.col("ID").cast("bigint").alias("id"), F.col("Arrest").alias("raw"))
    return raw.select("id", "raw", normalize_flag("raw").alias("flag"))


@register("presence_flag")
def q_presence_flag(spark, d):
    return _loaded("violence", TT.raw_violence(spark, d)).groupBy("is_homicide").agg(
        F.count(F.lit(1)).alias("n"))


@register("calendar_parts")
def q_calendar_parts(spark, d):
    inc = TT.incidents(spark, d)
    return inc.select("id", *[c.alias(n) for n, c in calendar_parts("ts").items()])


# --- hotspots ----------------------------------------------------------------

K = 10


def seeded_hotspots(spark, d):
    pts = HS.valid_points(TT.points(spark, d))
    cents = HS.seed_centroids(pts, K)
    return HS.centroid_counts(cents, HS.nearest_centroid(pts, cents))


@register("valid_coords")
def q_valid_coords(spark, d):
    return HS.valid_points(TT.points(spark, d))


@register("assign_nearest")
def q_assign_nearest(spark, d):
    pts = HS.valid_points(TT.points(spark, d))
    return HS.nearest_centroid(pts, HS.seed_centroids(pts, K)).select("id", "cluster_id")


@register("hotspot_counts")
def q_hotspot_counts(spark, d):
    return seeded_hotspots(spark, d)


@register("hotspots_ranked")
def q_hotspots_ranked(spark, d):
    return SV.hotspots_ranked(seeded_hotspots(spark, d))


@register("hotspots")
def q_hotspots(spark, d):
    hs, _ = HS.detect_hotspots(TT.points(spark, d), k=K, seed=42, max_iter=20)
    return hs


@register("hotspots_checks")
def q_hotspots_checks(spark, d):
    return HS.hotspot_checks(TT.points(spark, d), k=K, seed=42, max_iter=20)


@register("kpi_overview")
def q_kpi_overview(spark, d):
    # each figure from the one set it needs; a cluster is a row of its centroids
    return SV.kpi_overview(alerts_mart(spark, d), TR.trend(TT.incidents(spark, d), "year"),
                           HS.seed_centroids(TT.points(spark, d), K), VI.violence_by(TT.violence(spark, d), "district"))


# --- mart storage round trips ------------------------------------------------


def _scratch(spark, what):
    return scratch_path(spark, f"{what}-{uuid.uuid4().hex[:12]}")


@register("mart_roundtrip")
def q_mart_roundtrip(spark, d):
    base = _scratch(spark, "marts")
    MT.write_mart(VI.violence_stats(TT.violence(spark, d)), "violence_stats", base)
    return MT.read_mart(spark, "violence_stats", base)


@register("mart_append_twice")
def q_mart_append_twice(spark, d):
    """A run appended to a mart, repeated, and another run after it."""
    base = _scratch(spark, "marts")
    stats = VI.violence_stats(TT.violence(spark, d))
    MT.write_mart(stats, "violence_stats", base, mode="append", run_id="2024-01-01")
    MT.write_mart(stats, "violence_stats", base, mode="append", run_id="2024-01-01")
    MT.write_mart(VI.violence_by(TT.violence(spark, d), "month"), "violence_stats", base, mode="append", run_id="2024-02-01")
    kept = MT.read_mart(spark, "violence_stats", base)
    return kept.select(*stats.columns, F.col("run_id").cast("string").alias("run_id"))


@register("mart_read")
def q_mart_read(spark, d):
    base = _scratch(spark, "marts")
    MT.write_mart(TR.incident_trends(TT.incidents(spark, d)), "crime_trends", base)
    trends = MT.read_mart(spark, "crime_trends", base)
    return trends.filter(F.col("group_type") == "year").select("group_type", "group_value", "crime_count")


@register("alerts_latest_docs")
def q_alerts_latest_docs(spark, d):
    path = _scratch(spark, "alert-docs")
    MT.write_alert_docs(newest_alerts(spark, d, 20), path, mode="overwrite")
    return MT.latest_alert_docs(MT.read_alert_docs(spark, path), 20)


@register("scan_csv_typed")
def q_scan_csv_typed(spark, d):
    path = _scratch(spark, "incidents-csv")
    TT.raw_incidents(spark, d).write.mode("overwrite").option("header", "true").csv(path)
    return LD.load_incidents(spark, path).select(
        "id", "case_number", "date", "ts", "primary_type", "arrest", "district", "community_area",
        "year", "latitude", "longitude")


# --- Structured Streaming runs (file source, availableNow) -----------------
@register("stream_alerts")
def q_stream_alerts(spark, d):
    from blotter.streaming.pipeline import stream_alerts
    return stream_alerts(spark, TT.message_rows(spark, d), WINDOW_SECONDS, THRESHOLD,
                         work=_scratch(spark, "stream"))


@register("stream_alerts_table")
def q_stream_alerts_table(spark, d):
    """The earlier name of the run with table state, which ``stream_alerts`` now is."""
    return q_stream_alerts(spark, d)


@register("stream_alerts_state_store")
def q_stream_alerts_state_store(spark, d):
    from blotter.streaming.pipeline import stream_alerts_state_store
    return stream_alerts_state_store(spark, TT.message_rows(spark, d), WINDOW_SECONDS, THRESHOLD,
                                     work=_scratch(spark, "stream-store"))


@register("stream_alert_documents")
def q_stream_alert_documents(spark, d):
    from blotter.streaming.pipeline import stream_alert_documents
    return stream_alert_documents(spark, TT.message_rows(spark, d), WINDOW_SECONDS, THRESHOLD,
                                  work=_scratch(spark, "stream-docs"))


@register("stream_rejected")
def q_stream_rejected(spark, d):
    from blotter.streaming.pipeline import stream_rejected
    return stream_rejected(spark, TT.message_rows(spark, d), work=_scratch(spark, "stream-rejected")).select("id", "value", "missing")


@register("stream_raw_events")
def q_stream_raw_events(spark, d):
    from blotter.streaming.pipeline import stream_raw_events
    return stream_raw_events(spark, TT.message_rows(spark, d), work=_scratch(spark, "stream-raw"))


@register("stream_window_alerts")
def q_stream_window_alerts(spark, d):
    from blotter.streaming.pipeline import stream_window_alerts
    return stream_window_alerts(spark, TT.message_rows(spark, d), WINDOW, SLIDE, "48 hours", THRESHOLD,
                                work=_scratch(spark, "stream-window-alerts"))


@register("stream_sliding_counts")
def q_stream_sliding_counts(spark, d):
    from blotter.streaming.pipeline import stream_window_counts
    return stream_window_counts(spark, TT.message_rows(spark, d), WINDOW, SLIDE, "48 hours",
                                work=_scratch(spark, "stream-windows"))


@register("stream_restart")
def q_stream_restart(spark, d):
    """Alerts of a stream stopped and restarted after each arrival, as its committed batches tell."""
    from blotter.streaming import commits, pipeline as SP
    out = SP.committed_run(spark, TT.message_rows(spark, d), WINDOW_SECONDS, THRESHOLD, chunks=2, work=_scratch(spark, "stream-restart"))
    return commits.read_committed(spark, out).select(*SP.ALERT_COLUMNS)


@register("stream_counters")
def q_stream_counters(spark, d):
    """Counters of the committed batches of a run."""
    from blotter.streaming import commits, pipeline as SP
    out = SP.committed_run(spark, TT.message_rows(spark, d), WINDOW_SECONDS, THRESHOLD, chunks=3, work=_scratch(spark, "stream-counters"))
    return commits.stream_counters(spark, out)


LATE_SECONDS, LATE_CHUNKS = 20 * 24 * 3600, 3


@register("stream_late_events")
def q_stream_late_events(spark, d):
    """Events put aside as late when the messages arrive dealt by id, out of time order."""
    from blotter.streaming import commits, pipeline as SP
    out = SP.committed_run(spark, TT.message_rows(spark, d), WINDOW_SECONDS, THRESHOLD, chunks=LATE_CHUNKS, work=_scratch(spark, "stream-late"),
                           delay_seconds=LATE_SECONDS, by=(F.col("id") % LATE_CHUNKS).cast("int"))
    return commits.read_committed(spark, out, "late").select("id", "ts", "district", "batch_id")


@register("stream_idle_stop")
def q_stream_idle_stop(spark, d):
    """Accepted events of a running stream that stops itself when nothing more comes."""
    from blotter.streaming.pipeline import stream_idle_stop
    return stream_idle_stop(spark, TT.message_rows(spark, d), work=_scratch(spark, "stream-idle"))


# --- nearest station (declared in the reference docs) ----------------------
@register("nearest_station")
def q_nearest_station(spark, d):
    from blotter.operators.spatial import nearest_site
    pts = HS.valid_points(TT.points(spark, d))
    out = nearest_site(pts, TT.stations(spark, d), site_id="district")
    return out.select("id", F.col("nearest_site").alias("district"),
                      F.round("nearest_d2", 6).alias("distance2"))


@register("nearest_supplier")
def q_nearest_supplier(spark, d):
    """The same over a site table that grows with the data."""
    from blotter.operators.spatial import nearest_site
    out = nearest_site(HS.valid_points(TT.points(spark, d)), TT.depots(spark, d), site_id="depot")
    return out.select("id", F.col("nearest_site").alias("depot"), F.round("nearest_d2", 6).alias("distance2"))
