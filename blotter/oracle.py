"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The CTEs repeat the view rules of ``blotter.sources.testtables``; DuckDB's
``dayofweek`` is 0 = Sunday, hence ``+ 1``.
"""

from __future__ import annotations

INCIDENTS = """incidents AS (
  SELECT event_id AS id,
         'C' || CAST(event_id AS VARCHAR) AS case_number,
         ts,
         CASE WHEN event_id % 37 = 0 THEN NULL ELSE event_type END AS primary_type,
         CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(user_id % 25 AS VARCHAR) END AS district,
         CAST(user_id % 77 AS VARCHAR) AS community_area,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 25 THEN 'TRUE' ELSE 'FALSE' END AS arrest,
         CASE WHEN event_id % 97 = 0 THEN '13/40/' || strftime(ts, '%Y %I:%M:%S %p')
              WHEN event_id % 7 = 0 THEN lower(strftime(ts, '%m/%d/%Y %I:%M:%S %p'))
              ELSE strftime(ts, '%m/%d/%Y %I:%M:%S %p') END AS date_text,
         lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') || 'XX E MAIN ST' AS block,
         '41.' || CAST(user_id % 9000 + 1000 AS VARCHAR) AS latitude,
         '-87.' || CAST(event_id % 9000 + 1000 AS VARCHAR) AS longitude,
         upper(event_type) AS description, CAST(user_id % 300 AS VARCHAR) AS beat
  FROM events)"""

ARRESTS = """arrests AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS case_number, o_orderdate AS ts, o_orderpriority AS race
  FROM orders)"""

VIOLENCE = """violence AS (
  SELECT CAST(month(l_shipdate) AS VARCHAR) AS month,
         CAST(l_suppkey % 25 AS VARCHAR) AS district,
         CAST(l_partkey % 77 AS VARCHAR) AS community_area,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_homicide,
         CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS gunshot_injury_i
  FROM lineitem)"""

REGISTRY = """registry AS (
  SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS gender,
         CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'N' END AS victim_minor
  FROM customer)"""

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- calendar trends -------------------------------------------------------
_PARTS = {"year": "year(ts)", "month": "month(ts)", "day_of_week": "dayofweek(ts) + 1", "hour": "hour(ts)"}


def _trend_sql(part: str) -> str:
    return (f"SELECT '{part}' AS group_type, CAST({_PARTS[part]} AS VARCHAR) AS group_value, "
            f"count(*) AS crime_count FROM incidents WHERE ts IS NOT NULL GROUP BY {_PARTS[part]}")


ORACLE["incident_trends"] = _with(INCIDENTS) + "\nUNION ALL\n".join(_trend_sql(p) for p in _PARTS)
for _p, _k in [("year", "trend_year"), ("month", "trend_month"), ("day_of_week", "trend_dow"),
               ("hour", "trend_hour")]:
    ORACLE[_k] = _with(INCIDENTS) + _trend_sql(_p)


def _summary_sql(label: str, key: str, keep_null: bool = False) -> str:
    where = "" if keep_null else f"WHERE {key} IS NOT NULL "
    return (f"SELECT '{label}' AS group_type, CAST({key} AS VARCHAR) AS group_value, count(*) AS crime_count, "
            f"count(*) FILTER (WHERE arrest = 'TRUE') AS arrest_count FROM incidents {where}GROUP BY {key}")


ORACLE["incident_summary"] = _with(INCIDENTS) + "\nUNION ALL\n".join(
    [_summary_sql(p, e) for p, e in _PARTS.items()]
    + [_summary_sql("crime_type", "primary_type", True), _summary_sql("district", "district"),
       _summary_sql("community_area", "community_area")])


# --- arrest rates ----------------------------------------------------------
def _arrest_sql(label: str, key: str, keep_null: bool) -> str:
    where = "" if keep_null else f"WHERE {key} IS NOT NULL "
    return (f"SELECT '{label}' AS group_type, {key} AS group_value, count(*) AS total_crimes, "
            f"count(*) FILTER (WHERE arrest = 'TRUE') AS total_arrests, "
            f"round(count(*) FILTER (WHERE arrest = 'TRUE') / count(*), 4) AS arrest_rate "
            f"FROM incidents {where}GROUP BY {key}")


_RACE = ("SELECT 'race' AS group_type, race AS group_value, "
         "(SELECT count(*) FROM incidents) AS total_crimes, count(*) AS total_arrests, "
         "round(count(*) / NULLIF((SELECT count(*) FROM incidents), 0), 6) AS arrest_rate "
         "FROM arrests WHERE race IS NOT NULL GROUP BY race")

ORACLE["arrest_rate_type"] = _with(INCIDENTS) + _arrest_sql("crime_type", "primary_type", True)
ORACLE["arrest_rate_district"] = _with(INCIDENTS) + _arrest_sql("district", "district", False)
ORACLE["arrest_rate_area"] = _with(INCIDENTS) + _arrest_sql("community_area", "community_area", False)
ORACLE["arrest_rate_race"] = _with(INCIDENTS, ARRESTS) + _RACE
ORACLE["arrest_rates"] = (_with(INCIDENTS, ARRESTS) + _arrest_sql("crime_type", "primary_type", True)
                          + "\nUNION ALL\n" + _arrest_sql("district", "district", False)
                          + "\nUNION ALL\n" + _RACE)


# --- violence --------------------------------------------------------------
def _violence_sql(key: str) -> str:
    return (f"SELECT '{key}' AS group_type, {key} AS group_value, count(*) AS total_incidents, "
            "CAST(sum(is_homicide) AS BIGINT) AS homicides, "
            "CAST(sum(CASE WHEN is_homicide = 0 THEN 1 ELSE 0 END) AS BIGINT) AS non_fatal_shootings, "
            "CAST(sum(CASE WHEN gunshot_injury_i = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS gunshot_injuries, "
            "round(sum(CASE WHEN gunshot_injury_i = 'Y' THEN 1 ELSE 0 END) / count(*), 4) AS gunshot_proportion "
            f"FROM violence WHERE {key} IS NOT NULL GROUP BY {key}")


ORACLE["violence_month"] = _with(VIOLENCE) + _violence_sql("month")
ORACLE["violence_district"] = _with(VIOLENCE) + _violence_sql("district")
ORACLE["violence_area"] = _with(VIOLENCE) + _violence_sql("community_area")
ORACLE["violence_stats"] = _with(VIOLENCE) + "\nUNION ALL\n".join(
    _violence_sql(k) for k in ("month", "district", "community_area"))


# --- registry --------------------------------------------------------------
_REG_ALL = ("SELECT 'all' AS district, count(*) AS offender_count, "
            "count(*) FILTER (WHERE victim_minor = 'Y') AS minor_victim_count, "
            "round(count(*) FILTER (WHERE victim_minor = 'Y') / greatest(count(*), 1), 4) "
            "AS minor_victim_proportion FROM registry")
_REG_GENDER = ("SELECT gender AS district, count(*) AS offender_count, "
               "count(*) FILTER (WHERE victim_minor = 'Y') AS minor_victim_count, "
               "round(count(*) FILTER (WHERE victim_minor = 'Y') / count(*), 4) "
               "AS minor_victim_proportion FROM registry GROUP BY gender")
ORACLE["registry_summary"] = _with(REGISTRY) + _REG_ALL
ORACLE["registry_by_gender"] = _with(REGISTRY) + _REG_GENDER
ORACLE["registry_stats"] = _with(REGISTRY) + _REG_ALL + "\nUNION ALL\n" + _REG_GENDER
ORACLE["priority_records"] = _with(REGISTRY) + "SELECT gender, victim_minor FROM registry WHERE victim_minor = 'Y'"


# --- correlations ----------------------------------------------------------
_CORR_DISTRICT = """SELECT 'violence_rate_vs_arrest_rate' AS correlation_type, l.district AS group_key,
       'arrest_rate' AS metric_1_name, l.arrest_rate AS metric_1_value,
       'violence_count' AS metric_2_name, CAST(r.violence_count AS DOUBLE) AS metric_2_value,
       CAST(NULL AS DOUBLE) AS correlation_value
FROM (SELECT district, round(count(*) FILTER (WHERE arrest = 'TRUE') / count(*), 4) AS arrest_rate
      FROM incidents WHERE district IS NOT NULL GROUP BY district) l
JOIN (SELECT district, count(*) AS violence_count FROM violence WHERE district IS NOT NULL GROUP BY district) r
  ON l.district = r.district"""
_CORR_AREA = """SELECT 'crime_count_vs_violence_count' AS correlation_type, l.community_area AS group_key,
       'crime_count' AS metric_1_name, CAST(l.crime_count AS DOUBLE) AS metric_1_value,
       'violence_count' AS metric_2_name, CAST(r.violence_count AS DOUBLE) AS metric_2_value,
       CAST(NULL AS DOUBLE) AS correlation_value
FROM (SELECT community_area, count(*) AS crime_count FROM incidents
      WHERE community_area IS NOT NULL GROUP BY community_area) l
JOIN (SELECT community_area, count(*) AS violence_count FROM violence
      WHERE community_area IS NOT NULL GROUP BY community_area) r
  ON l.community_area = r.community_area"""
_CORRELATIONS = _CORR_DISTRICT + "\nUNION ALL\n" + _CORR_AREA
ORACLE["corr_district"] = _with(INCIDENTS, VIOLENCE) + _CORR_DISTRICT
ORACLE["corr_area"] = _with(INCIDENTS, VIOLENCE) + _CORR_AREA
ORACLE["correlations"] = _with(INCIDENTS, VIOLENCE) + _CORRELATIONS
ORACLE["corr_summary"] = (_with(INCIDENTS, VIOLENCE, f"corr AS ({_CORRELATIONS})") + """
SELECT correlation_type, count(*) AS n,
       round(corr(metric_1_value, metric_2_value), 6) AS pearson_r,
       round(regr_slope(metric_2_value, metric_1_value), 6) AS slope,
       round(regr_intercept(metric_2_value, metric_1_value), 6) AS intercept,
       round(regr_r2(metric_2_value, metric_1_value), 6) AS r2,
       array_to_string(list_transform(string_split(replace(correlation_type, '_', ' '), ' '),
                       lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title
FROM corr GROUP BY correlation_type""")


# --- stream operators, batch form ------------------------------------------
W_SECONDS = 24 * 3600
SLIDE_SECONDS = 6 * 3600
THRESHOLD = 10

ACCEPTED = """accepted AS (
  SELECT id, ts, case_number, strftime(ts, '%m/%d/%Y %I:%M:%S %p') AS date, '' AS block,
         primary_type, district, arrest, '' AS latitude, '' AS longitude, '' AS description,
         community_area, '' AS beat
  FROM incidents
  WHERE id % 50 NOT IN (0, 1) AND district IS NOT NULL AND primary_type IS NOT NULL)"""

TRAILING = f"""trail AS (
  SELECT id, ts, district,
         count(*) OVER (PARTITION BY district ORDER BY ts
                        RANGE BETWEEN INTERVAL {W_SECONDS} SECONDS PRECEDING AND CURRENT ROW)
         - count(*) OVER (PARTITION BY district, ts)
         + row_number() OVER (PARTITION BY district, ts ORDER BY id) AS event_count
  FROM accepted)"""

ALERTS = f"""alerts AS (
  SELECT district, ts AS timestamp, CAST(event_count AS INTEGER) AS event_count,
         CAST({THRESHOLD} AS INTEGER) AS threshold,
         CASE WHEN event_count > {2 * THRESHOLD} THEN 'HIGH' ELSE 'MEDIUM' END AS severity
  FROM trail WHERE event_count > {THRESHOLD})"""

_W_US, _S_US = W_SECONDS * 1_000_000, SLIDE_SECONDS * 1_000_000
WINDOWS = f"""windows AS (
  SELECT make_timestamp(s) AS window_start, make_timestamp(s + {_W_US}) AS window_end,
         district, count(*) AS event_count
  FROM (SELECT district, t, unnest(generate_series(t // {_S_US} * {_S_US} - {_W_US - _S_US},
                                                  t // {_S_US} * {_S_US}, {_S_US})) AS s
        FROM (SELECT district, epoch_us(ts) AS t FROM accepted))
  WHERE t >= s AND t < s + {_W_US}
  GROUP BY s, district)"""

_STREAM = _with(INCIDENTS, ACCEPTED, TRAILING, ALERTS, WINDOWS)

ORACLE["validate_events"] = _with(INCIDENTS, ACCEPTED) + "SELECT * FROM accepted"
ORACLE["rejected_events"] = _with(INCIDENTS) + """
SELECT id, value, missing FROM (
  SELECT id,
    CASE WHEN id % 50 = 1 THEN json_object('DATE', d, 'BLOCK', '', 'PRIMARY TYPE', pt, 'DISTRICT', di,
                                           'ARREST', arrest, 'LATITUDE', '', 'LONGITUDE', '', 'DESCRIPTION', '',
                                           'COMMUNITY AREA', community_area, 'BEAT', '')
         ELSE json_object('CASE NUMBER', case_number, 'DATE', d, 'BLOCK', '', 'PRIMARY TYPE', pt, 'DISTRICT', di,
                          'ARREST', arrest, 'LATITUDE', '', 'LONGITUDE', '', 'DESCRIPTION', '',
                          'COMMUNITY AREA', community_area, 'BEAT', '') END::VARCHAR AS value,
    concat_ws(',', CASE WHEN id % 50 = 1 THEN 'CASE NUMBER' END, CASE WHEN di = '' THEN 'DISTRICT' END,
              CASE WHEN pt = '' THEN 'PRIMARY TYPE' END) AS missing
  FROM (SELECT *, strftime(ts, '%m/%d/%Y %I:%M:%S %p') AS d, coalesce(primary_type, '') AS pt,
               CASE WHEN id % 50 = 0 THEN '' ELSE coalesce(district, '') END AS di FROM incidents))
WHERE missing <> ''"""
ORACLE["route_key"] = _with(INCIDENTS, ACCEPTED) + "SELECT id, coalesce(district, 'UNKNOWN') AS route_key FROM accepted"
ORACLE["events_to_json"] = _with(INCIDENTS) + """
SELECT id, json_object('CASE NUMBER', case_number, 'DATE', date_text, 'BLOCK', block,
                       'PRIMARY TYPE', coalesce(primary_type, ''), 'DISTRICT', district, 'ARREST', arrest,
                       'LATITUDE', latitude, 'LONGITUDE', longitude, 'DESCRIPTION', description,
                       'COMMUNITY AREA', community_area, 'BEAT', beat)::VARCHAR AS value
FROM incidents WHERE district IS NOT NULL AND district <> '' AND case_number <> ''"""
ORACLE["trailing_count"] = _STREAM + "SELECT * FROM trail"
ORACLE["trailing_count_ranked"] = ORACLE["trailing_count"]

def _ties_sql(copies: int) -> str:
    return _with(INCIDENTS, ACCEPTED) + f"""
SELECT id, ts, district,
       count(*) OVER (PARTITION BY district ORDER BY ts
                      RANGE BETWEEN INTERVAL {W_SECONDS} SECONDS PRECEDING AND CURRENT ROW)
       - count(*) OVER (PARTITION BY district, ts)
       + row_number() OVER (PARTITION BY district, ts ORDER BY id) AS event_count
FROM (SELECT id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, district FROM accepted, range({copies}))"""


ORACLE["trailing_count_ties"] = _ties_sql(1)
ORACLE["trailing_count_repeats"] = _ties_sql(2)
ORACLE["alerts"] = _STREAM + "SELECT * FROM alerts"
ORACLE["alerts_crossing"] = _STREAM + f"""
SELECT district, ts AS timestamp, CAST(event_count AS INTEGER) AS event_count,
       CAST({THRESHOLD} AS INTEGER) AS threshold,
       CASE WHEN event_count > {2 * THRESHOLD} THEN 'HIGH' ELSE 'MEDIUM' END AS severity
FROM (SELECT *, lag(event_count) OVER (PARTITION BY district ORDER BY ts, id) AS prev FROM trail)
WHERE event_count > {THRESHOLD} AND (prev IS NULL OR prev <= {THRESHOLD})"""
ORACLE["sliding_counts"] = _STREAM + "SELECT * FROM windows"
ORACLE["window_alerts"] = _STREAM + f"""
SELECT district, window_start, window_end, CAST(event_count AS INTEGER) AS event_count,
       CAST({THRESHOLD} AS INTEGER) AS threshold,
       CASE WHEN event_count > {2 * THRESHOLD} THEN 'HIGH' ELSE 'MEDIUM' END AS severity
FROM windows WHERE event_count > {THRESHOLD}"""
_NEWEST = "SELECT * FROM alerts ORDER BY timestamp DESC, district ASC, event_count DESC LIMIT {n}"
ORACLE["severity_mix"] = _STREAM + (
    f"SELECT severity, count(*) AS alert_count FROM ({_NEWEST.format(n=50)}) GROUP BY severity")
ORACLE["recent_alerts"] = _STREAM + _NEWEST.format(n=10)
ORACLE["busiest_now"] = _STREAM + """
SELECT district, window_size FROM (
  SELECT district, first(event_count ORDER BY ts DESC, id DESC) AS window_size FROM trail GROUP BY district)
ORDER BY window_size DESC, district ASC LIMIT 5"""


# --- serving top-k and labels ----------------------------------------------
def _top(sql: str, group_type: str, measure: str, k: int) -> str:
    return (f"SELECT * FROM ({sql}) WHERE group_type = '{group_type}' "
            f"ORDER BY {measure} DESC, group_value ASC NULLS FIRST LIMIT {k}")


ORACLE["top_types"] = _with(INCIDENTS) + _top(_arrest_sql("crime_type", "primary_type", True),
                                               "crime_type", "arrest_rate", 10)
ORACLE["top_areas"] = _with(VIOLENCE) + _top(_violence_sql("community_area"), "community_area",
                                              "total_incidents", 10)
ORACLE["top15_types"] = _with(INCIDENTS, ARRESTS) + _top(
    _arrest_sql("crime_type", "primary_type", True) + " UNION ALL " + _arrest_sql("district", "district", False)
    + " UNION ALL " + _RACE, "crime_type", "arrest_rate", 15)
ORACLE["top20_areas"] = _with(VIOLENCE) + _top(" UNION ALL ".join(
    _violence_sql(k) for k in ("month", "district", "community_area")), "community_area", "total_incidents", 20)
ORACLE["trend_labels"] = _with(INCIDENTS, "trends AS (" + "\nUNION ALL\n".join(_trend_sql(p) for p in _PARTS) + ")") + """
SELECT group_type, group_value, crime_count,
       CASE group_type
         WHEN 'month' THEN ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][CAST(group_value AS INTEGER)]
         WHEN 'day_of_week' THEN ['Sun','Mon','Tue','Wed','Thu','Fri','Sat'][CAST(group_value AS INTEGER)]
         ELSE group_value END AS label,
       CAST(group_value AS INTEGER) AS sort_key
FROM trends"""


# --- loaders ---------------------------------------------------------------
def _date_text(ts: str, key: str) -> str:
    txt = f"strftime({ts}, '%m/%d/%Y %I:%M:%S %p')"
    return (f"CASE WHEN {key} % 97 = 0 THEN '13/40/' || strftime({ts}, '%Y %I:%M:%S %p') "
            f"WHEN {key} % 7 = 0 THEN lower({txt}) ELSE {txt} END")


def _flag_text(cond: str, key: str, yes: str, no: str) -> str:
    base = f"CASE WHEN {cond} THEN '{yes}' ELSE '{no}' END"
    return (f"CASE {key} % 4 WHEN 0 THEN {base} WHEN 1 THEN ' ' || lower({base}) || ' ' "
            f"WHEN 2 THEN upper(left({base}, 1)) || lower(substr({base}, 2)) ELSE NULL END")


_PARSE = "CAST(try_strptime({c}, '%m/%d/%Y %I:%M:%S %p') AS TIMESTAMP)"

RAW_INCIDENTS = f"""raw_incidents AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         CASE WHEN event_id % 53 = 0 THEN NULL ELSE 'C' || CAST(event_id AS VARCHAR) END AS case_number,
         {_date_text('ts', 'event_id')} AS date,
         event_type AS primary_type,
         {_flag_text("CAST(json_extract_string(props, '$.k') AS INTEGER) < 25", 'event_id', 'TRUE', 'FALSE')} AS arrest_raw,
         CAST(user_id % 25 AS VARCHAR) AS district, CAST(user_id % 77 AS VARCHAR) AS community_area,
         CASE WHEN event_id % 89 = 0 THEN 'n/a' ELSE CAST(year(ts) AS VARCHAR) END AS year_raw,
         value AS latitude, CAST(user_id AS DOUBLE) AS longitude
  FROM events)"""

ORACLE["load_incidents"] = _with(RAW_INCIDENTS) + f"""
SELECT id, case_number, date, {_PARSE.format(c='date')} AS ts, primary_type, upper(trim(arrest_raw)) AS arrest,
       district, community_area, CAST(year_raw AS INTEGER) AS year, latitude, longitude
FROM raw_incidents WHERE case_number IS NOT NULL AND try_cast(year_raw AS INTEGER) IS NOT NULL"""

ORACLE["load_arrests"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS cb_no, CAST(o_orderkey AS VARCHAR) AS case_number,
       {_date_text('o_orderdate', 'o_orderkey')} AS arrest_date,
       {_PARSE.format(c=_date_text('o_orderdate', 'o_orderkey'))} AS ts,
       o_orderpriority AS race, o_orderstatus AS charge_1_statute
FROM orders WHERE o_orderkey % 53 <> 0"""

ORACLE["load_violence"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS case_number,
       {_date_text('l_shipdate', 'k')} AS date, {_PARSE.format(c=_date_text('l_shipdate', 'k'))} AS ts,
       upper(trim({_flag_text("l_linestatus = 'F'", 'k', 'Y', 'N')})) AS gunshot_injury_i,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_homicide,
       CAST(l_partkey % 77 AS VARCHAR) AS community_area, CAST(l_suppkey % 25 AS VARCHAR) AS district,
       CAST(month(l_shipdate) AS VARCHAR) AS month, l_extendedprice AS latitude, l_discount AS longitude
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem) WHERE k % 89 <> 0"""

ORACLE["load_registry"] = f"""
SELECT c_name AS last, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS gender,
       upper(trim({_flag_text('c_acctbal < 0', 'c_custkey', 'Y', 'N')})) AS victim_minor
FROM customer"""

ORACLE["load_stations"] = """
SELECT CAST(n_nationkey AS VARCHAR) AS district, n_name AS district_name,
       CAST(900.0 + n_nationkey * 40.0 AS DOUBLE) AS latitude,
       CAST(n_regionkey * 10.0 + 1.0 AS DOUBLE) AS longitude
FROM nation WHERE n_nationkey % 10 <> 9"""

ORACLE["parse_ts"] = _with(RAW_INCIDENTS) + f"SELECT CAST(id AS BIGINT) AS id, date AS raw, {_PARSE.format(c='date')} AS parsed FROM raw_incidents"
ORACLE["normalize_flags"] = _with(RAW_INCIDENTS) + "SELECT CAST(id AS BIGINT) AS id, arrest_raw AS raw, upper(trim(arrest_raw)) AS flag FROM raw_incidents"
ORACLE["presence_flag"] = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_homicide, count(*) AS n
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem) WHERE k % 89 <> 0 GROUP BY 1"""
ORACLE["calendar_parts"] = """
SELECT event_id AS id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour
FROM events"""


# --- hotspots ----------------------------------------------------------------
K = 10
POINTS = """points AS (
  SELECT p_partkey AS id,
         CASE WHEN p_partkey % 50 = 0 THEN 0.0 ELSE p_retailprice END AS latitude,
         CASE WHEN p_partkey % 50 = 1 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS longitude
  FROM part),
valid AS (SELECT * FROM points WHERE latitude IS NOT NULL AND longitude IS NOT NULL
                                 AND latitude <> 0.0 AND longitude <> 0.0)"""
SEEDS = f"""seeds AS (
  SELECT CAST(id % {K} AS INTEGER) AS cluster_id, round(avg(latitude), 6) AS latitude,
         round(avg(longitude), 6) AS longitude
  FROM valid GROUP BY 1)"""
ASSIGNED = """assigned AS (
  SELECT v.id, first(s.cluster_id ORDER BY (v.latitude - s.latitude) * (v.latitude - s.latitude)
                                           + (v.longitude - s.longitude) * (v.longitude - s.longitude),
                     s.cluster_id) AS cluster_id
  FROM valid v, seeds s GROUP BY v.id)"""
HOTSPOTS = """hotspots AS (
  SELECT s.cluster_id, s.latitude, s.longitude, CAST(coalesce(c.n, 0) AS BIGINT) AS crime_count
  FROM seeds s LEFT JOIN (SELECT cluster_id, count(*) AS n FROM assigned GROUP BY cluster_id) c
    ON s.cluster_id = c.cluster_id)"""
_HS = _with(POINTS, SEEDS, ASSIGNED, HOTSPOTS)
ORACLE["valid_coords"] = _with(POINTS) + "SELECT * FROM valid"
ORACLE["assign_nearest"] = _HS + "SELECT id, cluster_id FROM assigned"
ORACLE["hotspot_counts"] = _HS + "SELECT * FROM hotspots"
ORACLE["hotspots_ranked"] = _HS + "SELECT * FROM hotspots ORDER BY crime_count DESC, cluster_id"
ORACLE["kpi_overview"] = _with(INCIDENTS, ACCEPTED, TRAILING, ALERTS, VIOLENCE, POINTS, SEEDS, ASSIGNED, HOTSPOTS) + """
SELECT (SELECT count(*) FROM alerts) AS alerts_triggered,
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM incidents WHERE ts IS NOT NULL
                                                         GROUP BY year(ts))) AS total_records,
       (SELECT count(*) FROM hotspots) AS hotspot_clusters,
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM violence WHERE district IS NOT NULL
                                                         GROUP BY district)) AS violence_incidents"""


# --- mart storage round trips ------------------------------------------------
ORACLE["mart_roundtrip"] = ORACLE["violence_stats"]
ORACLE["mart_append_twice"] = (_with(VIOLENCE) + "SELECT *, '2024-01-01' AS run_id FROM ("
    + "\nUNION ALL\n".join(_violence_sql(k) for k in ("month", "district", "community_area"))
    + ")\nUNION ALL\nSELECT *, '2024-02-01' AS run_id FROM (" + _violence_sql("month") + ")")
ORACLE["mart_read"] = ORACLE["trend_year"]
ORACLE["alerts_latest_docs"] = _STREAM + _NEWEST.format(n=20)
ORACLE["scan_csv_typed"] = ORACLE["load_incidents"]

# The streaming runs must reproduce their batch forms exactly.
ORACLE["stream_alerts"] = ORACLE["alerts"]
ORACLE["stream_alerts_table"] = ORACLE["alerts"]
ORACLE["stream_alerts_state_store"] = ORACLE["alerts"]
ORACLE["stream_alert_documents"] = ORACLE["alerts"]
ORACLE["stream_rejected"] = ORACLE["rejected_events"]
ORACLE["stream_raw_events"] = ORACLE["validate_events"]
ORACLE["stream_window_alerts"] = ORACLE["window_alerts"]
ORACLE["stream_sliding_counts"] = ORACLE["sliding_counts"]
ORACLE["stream_restart"] = ORACLE["alerts"]
ORACLE["stream_idle_stop"] = ORACLE["validate_events"]
ORACLE["stream_counters"] = _STREAM + """
SELECT CAST(3 AS BIGINT) AS batches, (SELECT count(*) FROM accepted) AS processed,
       (SELECT count(*) FROM incidents) - (SELECT count(*) FROM accepted) AS rejected, CAST(0 AS BIGINT) AS late,
       (SELECT count(*) FROM alerts) AS alerts"""
ORACLE["stream_late_events"] = _with(INCIDENTS, ACCEPTED) + f"""
SELECT a.id, a.ts, a.district, CAST(a.id % 3 AS BIGINT) AS batch_id
FROM accepted a JOIN (
  SELECT c, max(newest) OVER (ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {20 * 24 * 3600} SECONDS AS mark
  FROM (SELECT id % 3 AS c, max(ts) AS newest FROM accepted GROUP BY 1)) m ON m.c = a.id % 3
WHERE a.ts < m.mark"""

STATIONS = """stations AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS district, CAST(900.0 + n_nationkey * 40.0 AS DOUBLE) AS latitude,
         CAST(n_regionkey * 10.0 + 1.0 AS DOUBLE) AS longitude FROM nation)"""
ORACLE["nearest_station"] = _with(POINTS, STATIONS) + """
SELECT id, first(district ORDER BY d2, district) AS district, round(min(d2), 6) AS distance2
FROM (SELECT v.id, s.district,
             (v.latitude - s.latitude) * (v.latitude - s.latitude)
             + (v.longitude - s.longitude) * (v.longitude - s.longitude) AS d2
      FROM valid v, stations s)
GROUP BY id"""

DEPOTS = """depots AS (
  SELECT s_suppkey AS depot, CAST(900.0 + (s_suppkey * 37) % 1100 AS DOUBLE) AS latitude,
         CAST((s_suppkey * 13) % 50 + 1 AS DOUBLE) AS longitude
  FROM supplier WHERE s_suppkey % 20 <> 7)"""
ORACLE["nearest_supplier"] = _with(POINTS, DEPOTS) + """
SELECT id, first(depot ORDER BY d2, depot) AS depot, round(min(d2), 6) AS distance2
FROM (SELECT v.id, s.depot,
             (v.latitude - s.latitude) * (v.latitude - s.latitude)
             + (v.longitude - s.longitude) * (v.longitude - s.longitude) AS d2
      FROM valid v, depots s)
GROUP BY id"""

# --- checks and slices -------------------------------------------------------
ORACLE["hotspots_checks"] = _with(POINTS) + (
    f"SELECT CAST({K} AS BIGINT) AS clusters, (SELECT count(*) FROM valid) AS points, true AS all_nearest, true AS below_mean")
ORACLE["rejected_rows"] = _with(RAW_INCIDENTS) + (
    "SELECT CAST(id AS BIGINT) AS id, 'year' AS field, year_raw AS value FROM raw_incidents WHERE year_raw = 'n/a'")


def _slice(sql: str, order: str) -> str:
    return f"SELECT *, CAST(row_number() OVER (ORDER BY {order}, group_value NULLS FIRST) AS INTEGER) AS position FROM ({sql})"


_NUMERIC = "CAST(group_value AS INTEGER)"
ORACLE["slice_hours"] = _with(INCIDENTS) + _slice(_trend_sql("hour"), _NUMERIC)
ORACLE["slice_months"] = _with(INCIDENTS) + _slice(_trend_sql("month"), _NUMERIC)
ORACLE["slice_district_rates"] = _with(INCIDENTS) + _slice(_arrest_sql("district", "district", False), "arrest_rate DESC")
ORACLE["slice_race_arrests"] = _with(INCIDENTS, ARRESTS) + _slice(_RACE, "total_arrests DESC")
ORACLE["slice_violence_months"] = _with(VIOLENCE) + _slice(_violence_sql("month"), _NUMERIC)
