"""Every registered query against its DuckDB oracle (sf0.001; the driver uses sf0.01)."""

import pytest

from tests.conftest import SMALL
from tests.helpers import duck_bag, spark_bag

from blotter.catalog import QUERIES  # noqa: E402
from blotter.oracle import ORACLE  # noqa: E402

KEYS = sorted(ORACLE)


def test_every_query_has_an_oracle_except_kmeans():
    assert set(QUERIES) - set(ORACLE) == {"hotspots"} and set(ORACLE) < set(QUERIES)


def test_entry_registers_every_query():
    from __spark_entry__ import oracle_sql, queries
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


CANON = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    s_cols, s_rows = spark_bag(df)
    d_cols, d_rows = duck_bag(duck, ORACLE[key])
    assert s_cols == d_cols
    assert s_rows == d_rows
    rel = duck.sql(ORACLE[key])
    assert {c: CANON.get(t, t) for c, t in df.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["group_type", "group_value", "crime_count"]
    assert df.count() > 0
