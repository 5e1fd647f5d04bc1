"""Physical-plan checks: one scan per mart, pushdown, no pairwise joins."""

import pytest

from tests.conftest import SMALL

from blotter.catalog import QUERIES  # noqa: E402

SINGLE_SCAN = ["incident_trends", "violence_stats", "registry_stats", "sliding_counts",
               "arrest_rate_type", "priority_records", "validate_events"]
NO_WRITE = [k for k in QUERIES if not k.startswith("stream_") and k not in {
    "hotspots", "hotspots_checks", "mart_roundtrip", "mart_read", "alerts_latest_docs", "scan_csv_typed"}]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key", SINGLE_SCAN)
def test_single_scan(spark, key):
    plan = _final_plan(QUERIES[key](spark, SMALL))
    assert plan.count("FileScan parquet") == 1, plan


@pytest.mark.parametrize("key", NO_WRITE)
def test_no_cartesian_or_nested_loop_join(spark, key):
    plan = _plan(QUERIES[key](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_columns_pruned_at_scan(spark):
    plan = _plan(QUERIES["trend_year"](spark, SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_not_null_filter_reaches_scan(spark, tmp_path):
    from blotter.plans import arrests as AR
    from blotter.sources import testtables as TT
    TT.incidents(spark, SMALL).write.parquet(str(tmp_path / "inc"))
    inc = spark.read.parquet(str(tmp_path / "inc"))
    plan = _plan(AR.arrest_rate_district(inc))
    assert "PushedFilters: [IsNotNull(district)]" in plan, plan
    race = _plan(AR.arrest_rate_race(inc, TT.arrests(spark, SMALL)))
    assert "PushedFilters: [IsNotNull(o_orderpriority)]" in race, race
    assert race.count("FileScan parquet []") == 1, race


def test_trends_expand_counts_not_rows(spark):
    plan = _plan(QUERIES["incident_trends"](spark, SMALL))
    assert plan.index("Expand") < plan.index("partial_count") < plan.index("FileScan")


def test_one_timestamp_parse(spark):
    for key in ("load_incidents", "load_arrests", "load_violence"):
        assert QUERIES[key](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().lower().count("gettimestamp(") == 1


def test_only_used_message_fields_are_parsed(spark):
    plan = _plan(QUERIES["sliding_counts"](spark, SMALL))
    assert "JsonToStructs" in plan or "from_json" in plan
    parsed = plan[plan.index("from_json" if "from_json" in plan else "JsonToStructs"):][:400]
    assert "BEAT" not in parsed and "DISTRICT" in parsed


def test_busiest_now_shuffles_no_event_rows(spark):
    plan = _final_plan(QUERIES["busiest_now"](spark, SMALL))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    for piece in plan.split("Exchange hashpartitioning")[1:]:
        assert "partial_" in piece.split("FileScan")[0]
