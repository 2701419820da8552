"""Queries against their SQL, on the small tables."""

import duckdb
import pytest

from linkledger.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = queries.queries()[name](spark, DATA)
    columns = sorted(found.columns)
    want = con.execute(queries.oracle_sql()[name])
    assert sorted(d[0] for d in want.description) == columns
    at = [next(i for i, d in enumerate(want.description) if d[0] == c) for c in columns]
    expected = sorted(tuple(str(r[i]) for i in at) for r in want.fetchall())
    got = sorted(tuple(str(r[c]) for c in columns) for r in found.collect())
    assert len(got) == len(expected)
    assert [(a, b) for a, b in zip(got, expected) if a != b][:2] == []
