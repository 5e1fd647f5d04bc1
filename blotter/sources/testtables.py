"""Incident-shaped views over the provided parquet tables.

The provided tables are not incident data, so each input of the pipeline is
derived from one of them by a narrow projection (the scan reads only the
columns used). The NULLs and zeros are injected by key because the source
tables have none, and the NULL-group and coordinate rules would otherwise go
untested. Every rule is repeated in the DuckDB oracle (``blotter.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import MESSAGE_FIELDS

N_DISTRICTS = 25
N_AREAS = 77


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> id, case_number, ts, date (text; impossible where id % 97 = 0), primary_type, district,
    community_area, arrest, block, latitude, longitude, description, beat (texts)."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("C"), F.col("event_id").cast("string")).alias("case_number"),
        F.col("ts"),
        F.when(F.col("event_id") % 37 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("event_type")).alias("primary_type"),
        F.when(F.col("event_id") % 41 == 0, F.lit(None).cast("string"))
         .otherwise((F.col("user_id") % N_DISTRICTS).cast("string")).alias("district"),
        (F.col("user_id") % N_AREAS).cast("string").alias("community_area"),
        F.when(k < 25, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("arrest"),
        _date_text(F.col("ts"), F.col("event_id")).alias("date"),
        F.concat(F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0"), F.lit("XX E MAIN ST")).alias("block"),
        F.concat(F.lit("41."), (F.col("user_id") % 9000 + 1000).cast("string")).alias("latitude"),
        F.concat(F.lit("-87."), (F.col("event_id") % 9000 + 1000).cast("string")).alias("longitude"),
        F.upper("event_type").alias("description"),
        (F.col("user_id") % 300).cast("string").alias("beat"),
    )


def arrests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> case_number, ts, race."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("case_number"),
                    F.col("o_orderdate").alias("ts"),
                    F.col("o_orderpriority").alias("race"))


def violence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> month (string), district, community_area, is_homicide, gunshot_injury_i."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.month("l_shipdate").cast("string").alias("month"),
        (F.col("l_suppkey") % N_DISTRICTS).cast("string").alias("district"),
        (F.col("l_partkey") % N_AREAS).cast("string").alias("community_area"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.lit(0)).alias("is_homicide"),
        F.when(F.col("l_linestatus") == "F", F.lit("Y")).otherwise(F.lit("N")).alias("gunshot_injury_i"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> gender, victim_minor."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("gender"),
        F.when(F.col("c_acctbal") < 0, F.lit("Y")).otherwise(F.lit("N")).alias("victim_minor"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> district, district_name, latitude, longitude (a grid derived from the keys)."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("string").alias("district"),
        F.col("n_name").alias("district_name"),
        (F.lit(900.0) + F.col("n_nationkey") * F.lit(40.0)).alias("latitude"),
        (F.col("n_regionkey") * F.lit(10.0) + F.lit(1.0)).alias("longitude"),
    )


def depots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> depot, latitude, longitude (spread over the points' plane by key; NULL where key % 20 = 7)."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    return s.select(key.alias("depot"), (F.lit(900.0) + (key * 37) % 1100).alias("latitude"),
                    F.when(key % 20 != 7, ((key * 13) % 50 + 1).cast("double")).alias("longitude"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> id, latitude, longitude; zero and NULL coordinates injected by key."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_partkey") % 50 == 0, F.lit(0.0))
         .otherwise(F.col("p_retailprice")).alias("latitude"),
        F.when(F.col("p_partkey") % 50 == 1, F.lit(None).cast("double"))
         .otherwise(F.col("p_size").cast("double")).alias("longitude"),
    )


def message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents as event messages: (id, ts, value) with the JSON text in ``value``.

    Defects by key: ``id % 50 = 0`` has an empty DISTRICT, ``id % 50 = 1`` has
    no CASE NUMBER field at all.
    """
    inc = incidents(spark, sf_dir)
    date_txt = F.date_format("ts", "MM/dd/yyyy hh:mm:ss a")
    district = F.when(F.col("id") % 50 == 0, F.lit("")).otherwise(F.coalesce("district", F.lit("")))
    fields = {
        "CASE NUMBER": F.col("case_number"),
        "DATE": date_txt,
        "BLOCK": F.lit(""),
        "PRIMARY TYPE": F.coalesce("primary_type", F.lit("")),
        "DISTRICT": district,
        "ARREST": F.col("arrest"),
        "LATITUDE": F.lit(""),
        "LONGITUDE": F.lit(""),
        "DESCRIPTION": F.lit(""),
        "COMMUNITY AREA": F.col("community_area"),
        "BEAT": F.lit(""),
    }
    full = F.to_json(F.struct(*[fields[k].alias(k) for k in MESSAGE_FIELDS]))
    no_case = F.to_json(F.struct(*[fields[k].alias(k) for k in MESSAGE_FIELDS if k != "CASE NUMBER"]))
    return inc.select("id", "ts", F.when(F.col("id") % 50 == 1, no_case).otherwise(full).alias("value"))


# ---------------------------------------------------------------------------
# Raw CSV-layout rows (all strings) for the loader queries. Defects by key:
# missing case number (key % 53 = 0), impossible date (key % 97 = 0),
# lower-case am/pm (key % 7 = 0), non-numeric typed value (key % 89 = 0),
# and four spellings of each flag (key % 4).
# ---------------------------------------------------------------------------
def _date_text(ts, key):
    txt = F.date_format(ts, "MM/dd/yyyy hh:mm:ss a")
    return (F.when(key % 97 == 0, F.concat(F.lit("13/40/"), F.date_format(ts, "yyyy hh:mm:ss a")))
            .when(key % 7 == 0, F.lower(txt)).otherwise(txt))


def _flag_text(is_set, key, yes: str, no: str):
    base = F.when(is_set, F.lit(yes)).otherwise(F.lit(no))
    return (F.when(key % 4 == 0, base)
            .when(key % 4 == 1, F.concat(F.lit(" "), F.lower(base), F.lit(" ")))
            .when(key % 4 == 2, F.initcap(base))
            .otherwise(F.lit(None).cast("string")))


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.sources.loaders import raw_frame
    e = table(spark, sf_dir, "events")
    key = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    return raw_frame(e, "incidents", {
        "ID": key,
        "Case Number": F.when(key % 53 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), key.cast("string"))),
        "Date": _date_text(F.col("ts"), key),
        "Primary Type": F.col("event_type"),
        "Arrest": _flag_text(k < 25, key, "TRUE", "FALSE"),
        "District": F.col("user_id") % N_DISTRICTS,
        "Community Area": F.col("user_id") % N_AREAS,
        "Year": F.when(key % 89 == 0, F.lit("n/a")).otherwise(F.year("ts").cast("string")),
        "Latitude": F.col("value"),
        "Longitude": F.col("user_id").cast("double"),
    })


def raw_arrests(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.sources.loaders import raw_frame
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return raw_frame(o, "arrests", {
        "CB_NO": key,
        "CASE NUMBER": F.when(key % 53 == 0, F.lit(None)).otherwise(key.cast("string")),
        "ARREST DATE": _date_text(F.col("o_orderdate"), key),
        "RACE": F.col("o_orderpriority"),
        "CHARGE 1 STATUTE": F.col("o_orderstatus"),
    })


def raw_violence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.sources.loaders import raw_frame
    li = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return raw_frame(li, "violence", {
        "CASE_NUMBER": F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        "DATE": _date_text(F.col("l_shipdate"), key),
        "GUNSHOT_INJURY_I": _flag_text(F.col("l_linestatus") == "F", key, "Y", "N"),
        "COMMUNITY_AREA": F.col("l_partkey") % N_AREAS,
        "DISTRICT": F.col("l_suppkey") % N_DISTRICTS,
        "MONTH": F.month("l_shipdate"),
        "HOMICIDE_VICTIM_FIRST_NAME": F.when(F.col("l_returnflag") == "R",
                                             F.concat(F.lit("V"), F.col("l_orderkey").cast("string"))),
        "LATITUDE": F.when(key % 89 == 0, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string")),
        "LONGITUDE": F.col("l_discount"),
    })


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.sources.loaders import raw_frame
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return raw_frame(c, "registry", {
        "LAST": F.col("c_name"),
        "GENDER": F.when(key % 10 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")),
        "VICTIM MINOR": _flag_text(F.col("c_acctbal") < 0, key, "Y", "N"),
    })


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.sources.loaders import raw_frame
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return raw_frame(n, "stations", {
        "DISTRICT": F.when(key % 10 == 9, F.lit(None)).otherwise(key.cast("string")),
        "DISTRICT NAME": F.col("n_name"),
        "LATITUDE": F.lit(900.0) + key * F.lit(40.0),
        "LONGITUDE": F.col("n_regionkey") * F.lit(10.0) + F.lit(1.0),
    })
