"""The operators' queries against their DuckDB SQL over the smallest tables."""

import datetime as dt
import os

import duckdb
import pytest

from bookflow.llm.queries import ORACLES, QUERIES

from conftest import SF_SMALL

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order, cols = sorted(df.columns), rel.columns
    got = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    exp = sorted((tuple(_norm(row[cols.index(c)]) for c in order) for row in rel.fetchall()), key=repr)
    assert got == exp
