"""The queries that SQL can express against their oracle in DuckDB."""

import duckdb
import pytest

from tests.compare import same
from upswing.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLE_SQL[name]).df()
    types = lambda df: {c: df[c].dtype.kind for c in df}
    ok, why = same(got, want)
    assert ok, why
    assert len(got) > 0 and types(got) == types(want)
