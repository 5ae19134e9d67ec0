"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from tests.conftest import SMALL
from tidemark.plans.all import ORACLES, QUERIES
from tidemark.plans.fixtures import TABLES
from tools.check_oracles import duck_family, spark_family


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_documented():
    without = set(QUERIES) - set(ORACLES)
    assert without <= {"profile_approx"}, without


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    otypes = dict(zip(rel.columns, rel.types))
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert [c for c, t in df.dtypes if spark_family(t) != duck_family(otypes[c])] == []
    assert _canon(df.columns, got) == _canon(ocols, want)
