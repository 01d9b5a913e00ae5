"""Every registered query against its independent DuckDB SQL, on the
smallest test folder (the driver repeats this at sf0.01)."""

import datetime as dt
import decimal

import duckdb
import pytest
from support import SF_SMALL

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v


def _key(t):
    return tuple((x is None, str(x)) for x in t)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - {n for n in entry.queries() if n.startswith("op")}))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_key)
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert got == exp


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["actorid", "actor", "quality_class", "is_active", "start_year", "end_year", "current_year"]
    assert isinstance(dt.date.today(), dt.date)
