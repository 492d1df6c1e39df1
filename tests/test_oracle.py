"""Differential test: every registered query against its SQL oracle (DuckDB) at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from pitchline.plans.catalog import ORACLE, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
NAMES = sorted(QUERIES)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return repr(v)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "tournament_year"


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= E.queries().items() and ORACLE.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    oidx = [ocols.index(df.columns[i]) for i in order]
    a = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    b = sorted(tuple(_norm(r[i]) for i in oidx) for r in res.fetchall())
    assert a == b
