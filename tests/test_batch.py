"""Batch layer end to end: CSV inputs written from the test tables, staged, marts written."""

from tests.conftest import SMALL

from blotter.plans.batch import run_batch
from blotter.sources import marts as MT
from blotter.sources import testtables as TT


def test_run_batch_writes_every_mart(spark, scratch):
    paths = {}
    for kind, fn in [("incidents", TT.raw_incidents), ("arrests", TT.raw_arrests),
                     ("violence", TT.raw_violence), ("registry", TT.raw_registry)]:
        p = f"{scratch}/csv/{kind}"
        fn(spark, SMALL).write.option("header", "true").csv(p)
        paths[kind] = p
    out = f"{scratch}/marts"
    first = run_batch(spark, paths, out, k=4, max_iter=5)
    assert set(first) == {"crime_trends", "arrest_rates", "correlations", "hotspots",
                          "violence_stats", "sex_offender_stats"}
    second = run_batch(spark, paths, out, k=4, max_iter=5)      # idempotent re-run
    for name, n in second.items():
        assert MT.read_mart(spark, name, out).count() == n == first[name]
    years = MT.read_mart(spark, "crime_trends", out).filter("group_type = 'year'").collect()
    staged = spark.read.parquet(f"{out}/_staged/incidents/_status=good")
    assert sum(r.crime_count for r in years) == staged.filter("ts IS NOT NULL").count()


def test_cli_batch_and_stream(spark, scratch):
    import json
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    inc = f"{scratch}/inc"
    TT.raw_incidents(spark, SMALL).write.option("header", "true").csv(inc)
    env = dict(os.environ, PYTHONPATH=root)
    r = subprocess.run([sys.executable, "-m", "blotter", "--master", "local[2]", "batch", "--incidents", inc,
                        "--out", f"{scratch}/marts", "--k", "3", "--max-iter", "3"],
                       capture_output=True, text=True, env=env, timeout=600, check=True)
    written = json.loads(r.stdout.strip().splitlines()[-1])
    assert set(written) == {"crime_trends", "hotspots"} and written["hotspots"] == 3
    src = f"{scratch}/msgs"
    TT.message_rows(spark, SMALL).write.parquet(src)
    subprocess.run([sys.executable, "-m", "blotter", "--master", "local[2]", "stream", "--source", src,
                    "--format", "parquet", "--out", f"{scratch}/alerts", "--checkpoint", f"{scratch}/ck",
                    "--window-seconds", str(24 * 3600), "--threshold", "2", "--available-now"],
                   capture_output=True, text=True, env=env, timeout=600, check=True)
    assert spark.read.parquet(f"{scratch}/alerts").count() > 0


def test_marts_from_summaries_equal_standalone_plans(spark):
    from tests.helpers import spark_bag
    from blotter.plans import arrests as AR
    from blotter.plans import correlation as CO
    from blotter.plans import trends as TR
    from blotter.plans import violence as VI
    from blotter.plans.batch import incident_summary, marts_from_summaries, violence_summary
    inc, vio, arr = TT.incidents(spark, SMALL), TT.violence(spark, SMALL), TT.arrests(spark, SMALL)
    marts = marts_from_summaries(incident_summary(inc), violence_summary(vio), arr)
    assert spark_bag(marts["crime_trends"]) == spark_bag(TR.incident_trends(inc))
    assert spark_bag(marts["arrest_rates"]) == spark_bag(AR.arrest_rates(inc, arr))
    assert spark_bag(marts["correlations"]) == spark_bag(CO.correlations(inc, vio))
    assert spark_bag(marts["violence_stats"]) == spark_bag(VI.violence_stats(vio))


def test_marts_read_the_cached_summaries_not_the_inputs(spark, tmp_path):
    from blotter.plans.batch import incident_summary, marts_from_summaries, violence_summary
    TT.incidents(spark, SMALL).write.parquet(str(tmp_path / "inc"))
    inc = spark.read.parquet(str(tmp_path / "inc"))
    s_inc = incident_summary(inc).persist()
    s_vio = violence_summary(TT.violence(spark, SMALL)).persist()
    try:
        s_inc.count(), s_vio.count()
        for name, df in marts_from_summaries(s_inc, s_vio, TT.arrests(spark, SMALL)).items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "InMemoryTableScan" in plan, name     # served from the cached summary
    finally:
        s_inc.unpersist()
        s_vio.unpersist()
