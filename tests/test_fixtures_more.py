"""CSV edge cases for the violence, registry, arrests and stations inputs."""

import datetime as dt

from blotter.schemas import ARREST_COLUMNS, REGISTRY_COLUMNS, STATION_COLUMNS, VIOLENCE_COLUMNS
from blotter.sources import loaders as LD


def _csv(path, columns, rows):
    with open(path, "w") as f:
        f.write(",".join(columns) + "\n")
        for r in rows:
            f.write(",".join(r.get(c, "") for c in columns) + "\n")
    return str(path)


def test_violence_homicide_and_gunshot_flags(spark, tmp_path):
    p = _csv(tmp_path / "v.csv", VIOLENCE_COLUMNS, [
        {"CASE_NUMBER": "V1", "DATE": "03/04/2021 11:00:00 PM", "GUNSHOT_INJURY_I": " y ",
         "HOMICIDE_VICTIM_FIRST_NAME": "ANN", "MONTH": "3", "DISTRICT": "1", "LATITUDE": "41.8"},
        {"CASE_NUMBER": "V2", "DATE": "03/05/2021 01:00:00 AM", "GUNSHOT_INJURY_I": "N",
         "MONTH": "3", "DISTRICT": "1", "LATITUDE": "41.7"},
        {"CASE_NUMBER": "V3", "DATE": "", "GUNSHOT_INJURY_I": "", "MONTH": "", "DISTRICT": "",
         "LATITUDE": "x"},
    ])
    rows = {r.case_number: r for r in LD.load_violence(spark, p).collect()}
    assert sorted(rows) == ["V1", "V2"]                      # bad double rejected
    assert (rows["V1"].is_homicide, rows["V1"].gunshot_injury_i) == (1, "Y")
    assert (rows["V2"].is_homicide, rows["V2"].gunshot_injury_i) == (0, "N")
    assert rows["V1"].ts == dt.datetime(2021, 3, 4, 23, 0)
    from blotter.plans.violence import violence_stats
    got = {(r.group_type, r.group_value): (r.total_incidents, r.homicides, r.gunshot_injuries)
           for r in violence_stats(LD.load_violence(spark, p)).collect()}
    assert got == {("month", "3"): (2, 1, 1), ("district", "1"): (2, 1, 1)}


def test_registry_flags_and_null_gender(spark, tmp_path):
    p = _csv(tmp_path / "r.csv", REGISTRY_COLUMNS, [
        {"LAST": "A", "GENDER": "MALE", "VICTIM MINOR": " y "},
        {"LAST": "B", "GENDER": "", "VICTIM MINOR": "Y"},
        {"LAST": "C", "GENDER": "MALE", "VICTIM MINOR": "N"},
    ])
    from blotter.plans.registry import registry_stats
    got = {r.district: (r.offender_count, r.minor_victim_count, r.minor_victim_proportion)
           for r in registry_stats(LD.load_registry(spark, p)).collect()}
    assert got == {"all": (3, 2, 0.6667), "MALE": (2, 1, 0.5), None: (1, 1, 1.0)}


def test_arrests_and_stations_drop_missing_keys(spark, tmp_path):
    a = _csv(tmp_path / "a.csv", ARREST_COLUMNS, [
        {"CB_NO": "1", "CASE NUMBER": "JA1", "ARREST DATE": "12/31/2020 12:30:00 PM", "RACE": "WHITE"},
        {"CB_NO": "2", "CASE NUMBER": "", "ARREST DATE": "12/31/2020 12:30:00 PM", "RACE": "BLACK"},
    ])
    rows = LD.load_arrests(spark, a).collect()
    assert [(r.case_number, r.ts) for r in rows] == [("JA1", dt.datetime(2020, 12, 31, 12, 30))]
    s = _csv(tmp_path / "s.csv", STATION_COLUMNS, [
        {"DISTRICT": "1", "DISTRICT NAME": "Central", "LATITUDE": "41.85", "LONGITUDE": "-87.62"},
        {"DISTRICT": "", "DISTRICT NAME": "Headquarters", "LATITUDE": "41.83", "LONGITUDE": "-87.62"},
    ])
    assert [r.district_name for r in LD.load_stations(spark, s).collect()] == ["Central"]
