"""Every registered query against its oracle SQL in DuckDB on the sf0.01 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.compare import same

SF = "/root/testdata/sf0.01"
TABLES = ("events", "part")

#: The queries of this library; the optional operators have tests of their own.
OWN = sorted(entry._QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield c
    c.close()


def test_every_query_has_oracle():
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    ok, why = same(got, want)
    assert ok, why
    assert len(got) > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "date", "destination", "tleo", "genre", "streams", "non_nulls",
        "brand_avg28", "brand_sd28", "overall_avg28", "overall_sd28", "trend_score",
    ]
    assert df.count() > 0


@pytest.mark.parametrize(
    "setting", [("spark.sql.session.timeZone", "America/New_York"), ("spark.sql.ansi.enabled", "false")]
)
def test_results_do_not_depend_on_session_settings(spark, con, setting):
    key, value = setting
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        for name in ("surge_hourly_wide", "increment_wide", "plays_hourly"):
            got = entry.queries()[name](spark, SF).toPandas()
            ok, why = same(got, con.execute(entry.oracle_sql()[name]).df())
            assert ok, (name, why)
    finally:
        spark.conf.set(key, old)
