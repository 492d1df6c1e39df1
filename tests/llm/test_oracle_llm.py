"""Queries of the training-data operators that SQL can express, against their SQL (DuckDB)."""

import duckdb
import pytest

from pitchline.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = QUERIES[name](spark, sf_dir)
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(res.fetchall(), key=repr)
