"""The llm queries with SQL equal it on DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from flowlens.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    found = queries.queries()[name](spark, SMALL)
    order = sorted(found.columns)
    result = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == order
    want = sorted(tuple(dict(zip(names, r, strict=True))[c] for c in order) for r in result.fetchall())
    assert sorted(tuple(r[c] for c in order) for r in found.collect()) == want
