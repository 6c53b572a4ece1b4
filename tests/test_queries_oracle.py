"""Every registered query against its independent DuckDB oracle (sf0.001)."""

import datetime as dt
import math
import os
import sys

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

TABLES = ["nation", "customer", "orders"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
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


@pytest.mark.parametrize("name", sorted(set(E._QUERIES) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    cols = rel.columns
    exp = sorted((tuple(_norm(row[cols.index(c)]) for c in order) for row in rel.fetchall()), key=repr)
    assert got == exp


def test_every_query_has_a_callable_and_entry_runs(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.count() > 0


def test_queries_stay_when_a_dependency_of_the_optional_ones_is_missing(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # its import fails
    assert set(E.queries()) == set(E._QUERIES) and set(E.oracle_sql()) <= set(E._QUERIES)
