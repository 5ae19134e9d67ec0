"""Generated change feeds (hypothesis): type 1 against a model, and type 1 =
open versions of type 2 when every column is tracked."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import cdc, history

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 4)),        # key (nullable, few values -> hot keys)
                st.integers(0, 30),                              # sequence
                st.sampled_from(["a", "b", None]))               # value
FEED = st.lists(ROW, min_size=1, max_size=40)
SCHEMA = "k long, seq long, tb long, v string"


def _feed(rows):
    return [(k, s, i, v) for i, (k, s, v) in enumerate(rows)]


def _key(t):
    return tuple((x is not None, x) for x in t)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(FEED)
def test_type1_model(spark, rows):
    data = _feed(rows)
    latest = {}
    for r in data:
        if r[0] not in latest or (r[1], r[2]) > (latest[r[0]][1], latest[r[0]][2]):
            latest[r[0]] = r
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted(map(tuple, cdc.scd1(df, ["k"], "seq", tiebreak=["tb"], columns=["seq", "tb", "v"]).collect()),
                 key=_key)
    assert got == sorted(latest.values(), key=_key)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(FEED)
def test_type1_is_the_open_version_of_type2(spark, rows):
    df = spark.createDataFrame(_feed(rows), SCHEMA)
    t1 = cdc.scd1(df, ["k"], "seq", tiebreak=["tb"], columns=["seq", "tb", "v"])
    t2 = history.open_versions(cdc.scd2(df, ["k"], "seq", tiebreak=["tb"], track_columns=["v"],
                                        hot_key_rows=5))
    assert sorted(map(tuple, t1.collect()), key=_key) == \
        sorted(map(tuple, t2.select("k", "seq", "tb", "v").collect()), key=_key)
