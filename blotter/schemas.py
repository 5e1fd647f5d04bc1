"""Schemas: the five CSV inputs, the event message, and the seven result marts.

CSV files bind columns by position, so the column lists below must equal the
input files' layout exactly.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Input CSV layouts (header names in file order) and the
# declared type of each non-string column. They must match the source files.
# ---------------------------------------------------------------------------
INCIDENT_COLUMNS = [
    "ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
    "Location Description", "Arrest", "Domestic", "Beat", "District", "Ward",
    "Community Area", "FBI Code", "X Coordinate", "Y Coordinate", "Year",
    "Updated On", "Latitude", "Longitude", "Location",
]
INCIDENT_TYPES = {"Year": "int", "Latitude": "double", "Longitude": "double"}

STATION_COLUMNS = [
    "DISTRICT", "DISTRICT NAME", "ADDRESS", "CITY", "STATE", "ZIP", "WEBSITE",
    "PHONE", "FAX", "TTY", "X COORDINATE", "Y COORDINATE", "LATITUDE",
    "LONGITUDE", "LOCATION",
]
STATION_TYPES = {"X COORDINATE": "double", "Y COORDINATE": "double",
                 "LATITUDE": "double", "LONGITUDE": "double"}

ARREST_COLUMNS = [
    "CB_NO", "CASE NUMBER", "ARREST DATE", "RACE",
    "CHARGE 1 STATUTE", "CHARGE 1 DESCRIPTION", "CHARGE 1 TYPE", "CHARGE 1 CLASS",
    "CHARGE 2 STATUTE", "CHARGE 2 DESCRIPTION", "CHARGE 2 TYPE", "CHARGE 2 CLASS",
    "CHARGE 3 STATUTE", "CHARGE 3 DESCRIPTION", "CHARGE 3 TYPE", "CHARGE 3 CLASS",
    "CHARGE 4 STATUTE", "CHARGE 4 DESCRIPTION", "CHARGE 4 TYPE", "CHARGE 4 CLASS",
    "CHARGES STATUTE", "CHARGES DESCRIPTION", "CHARGES TYPE", "CHARGES CLASS",
]
ARREST_TYPES: dict[str, str] = {}

VIOLENCE_COLUMNS = [
    "CASE_NUMBER", "DATE", "BLOCK", "VICTIMIZATION_PRIMARY", "INCIDENT_PRIMARY",
    "GUNSHOT_INJURY_I", "UNIQUE_ID", "ZIP_CODE", "WARD", "COMMUNITY_AREA",
    "STREET_OUTREACH_ORGANIZATION", "AREA", "DISTRICT", "BEAT", "AGE", "SEX", "RACE",
    "VICTIMIZATION_FBI_CD", "INCIDENT_FBI_CD", "VICTIMIZATION_FBI_DESCR",
    "INCIDENT_FBI_DESCR", "VICTIMIZATION_IUCR_CD", "INCIDENT_IUCR_CD",
    "VICTIMIZATION_IUCR_SECONDARY", "INCIDENT_IUCR_SECONDARY",
    "HOMICIDE_VICTIM_FIRST_NAME", "HOMICIDE_VICTIM_MI", "HOMICIDE_VICTIM_LAST_NAME",
    "MONTH", "DAY_OF_WEEK", "HOUR", "LOCATION_DESCRIPTION", "STATE_HOUSE_DISTRICT",
    "STATE_SENATE_DISTRICT", "UPDATED", "LATITUDE", "LONGITUDE", "LOCATION",
]
VIOLENCE_TYPES = {"LATITUDE": "double", "LONGITUDE": "double"}

REGISTRY_COLUMNS = [
    "LAST", "FIRST", "BLOCK", "GENDER", "RACE", "BIRTH DATE", "HEIGHT", "WEIGHT",
    "VICTIM MINOR",
]
REGISTRY_TYPES: dict[str, str] = {}

# Event message fields in publish order, and the required ones.
MESSAGE_FIELDS = [
    "CASE NUMBER", "DATE", "BLOCK", "PRIMARY TYPE", "DISTRICT", "ARREST",
    "LATITUDE", "LONGITUDE", "DESCRIPTION", "COMMUNITY AREA", "BEAT",
]
REQUIRED_MESSAGE_FIELDS = ["CASE NUMBER", "DISTRICT", "DATE", "PRIMARY TYPE"]

# Fixed value: the 12-hour timestamp layout used by every date column.
TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"

# Labels and flag values stored in or compared against the data.
GT_YEAR, GT_MONTH, GT_DAY_OF_WEEK, GT_HOUR = "year", "month", "day_of_week", "hour"
GT_CRIME_TYPE, GT_DISTRICT, GT_RACE, GT_COMMUNITY_AREA = "crime_type", "district", "race", "community_area"
ARREST_FLAG = "TRUE"            # arrest flag after upper(trim())
YES_FLAG = "Y"                  # gunshot injury and victim-minor flags after upper(trim())
ALL_LABEL = "all"               # offender summary row
SEVERITY_HIGH, SEVERITY_MEDIUM = "HIGH", "MEDIUM"
UNKNOWN_DISTRICT = "UNKNOWN"    # routing key default

INPUTS = {
    "incidents": (INCIDENT_COLUMNS, INCIDENT_TYPES),
    "stations": (STATION_COLUMNS, STATION_TYPES),
    "arrests": (ARREST_COLUMNS, ARREST_TYPES),
    "violence": (VIOLENCE_COLUMNS, VIOLENCE_TYPES),
    "registry": (REGISTRY_COLUMNS, REGISTRY_TYPES),
}


def snake(name: str) -> str:
    """'Case Number' -> 'case_number'; 'X COORDINATE' -> 'x_coordinate'."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def raw_schema(columns: list[str]) -> T.StructType:
    """All-string read schema (types are applied later by ``try_cast``)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def message_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in MESSAGE_FIELDS])


# Result marts (surrogate ids and server-side audit defaults are added on write).
MARTS: dict[str, T.StructType] = {
    "crime_trends": T.StructType([
        T.StructField("group_type", T.StringType()),
        T.StructField("group_value", T.StringType()),
        T.StructField("crime_count", T.LongType()),
    ]),
    "hotspots": T.StructType([
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("crime_count", T.LongType()),
    ]),
    "alerts": T.StructType([
        T.StructField("district", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("event_count", T.IntegerType()),
        T.StructField("threshold", T.IntegerType()),
        T.StructField("severity", T.StringType()),
    ]),
    "correlations": T.StructType([
        T.StructField("correlation_type", T.StringType()),
        T.StructField("group_key", T.StringType()),
        T.StructField("metric_1_name", T.StringType()),
        T.StructField("metric_1_value", T.DoubleType()),
        T.StructField("metric_2_name", T.StringType()),
        T.StructField("metric_2_value", T.DoubleType()),
        T.StructField("correlation_value", T.DoubleType()),
    ]),
    "arrest_rates": T.StructType([
        T.StructField("group_type", T.StringType()),
        T.StructField("group_value", T.StringType()),
        T.StructField("total_crimes", T.LongType()),
        T.StructField("total_arrests", T.LongType()),
        T.StructField("arrest_rate", T.DoubleType()),
    ]),
    "violence_stats": T.StructType([
        T.StructField("group_type", T.StringType()),
        T.StructField("group_value", T.StringType()),
        T.StructField("total_incidents", T.LongType()),
        T.StructField("homicides", T.LongType()),
        T.StructField("non_fatal_shootings", T.LongType()),
        T.StructField("gunshot_injuries", T.LongType()),
        T.StructField("gunshot_proportion", T.DoubleType()),
    ]),
    "sex_offender_stats": T.StructType([
        T.StructField("district", T.StringType()),
        T.StructField("offender_count", T.LongType()),
        T.StructField("minor_victim_count", T.LongType()),
        T.StructField("minor_victim_proportion", T.DoubleType()),
    ]),
}

# Marts with an audit column filled at write time.
AUDIT_COLUMNS = {"crime_trends": "last_updated", "alerts": "created_at"}
