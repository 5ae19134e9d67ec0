"""Property tests for CDC apply against a brute-force model in plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, history

SCHEMA = "k long, seq long, tb long, a string, b long"


def brute_scd2(rows, track):
    """Per key in (seq, tb) order: a row opens a version when a tracked value changes."""
    out = []
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for k, rs in by_key.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))  # null sequences first
        versions = []
        for r in rs:
            tv = tuple(r[i] for i in track)
            if versions and versions[-1]["tv"] == tv:
                versions[-1]["last"] = r
            else:
                versions.append({"tv": tv, "start": r[1], "last": r})
        for i, v in enumerate(versions):
            end = versions[i + 1]["start"] if i + 1 < len(versions) else None
            last = v["last"]
            out.append((k, last[1], last[2], last[3], last[4], v["start"], end))
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


def _sorted(df):
    cols = ["k", "seq", "tb", "a", "b", "__START_AT", "__END_AT"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))


def _random_changes(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot key holds about a third of the rows; keys may be null
        k = 0 if rnd.random() < 0.33 else rnd.choice([1, 2, 3, 4, None])
        seq = None if rnd.random() < 0.03 else rnd.randrange(0, 60)
        rows.append((k, seq, i, rnd.choice(["x", "y", None]), rnd.choice([1, 2])))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("chunk_width", [1, 7, 1000])
def test_chunked_scd2_equals_brute_force(spark, seed, chunk_width):
    data = _random_changes(seed)
    df = spark.createDataFrame(data, SCHEMA)
    got = cdc.scd2(df, ["k"], "seq", tiebreak=["tb"], track_columns=["a"], chunk=F.floor(F.col("seq") / chunk_width))
    assert _sorted(got) == brute_scd2(data, track=[3])


def test_windowed_and_default_chunks_agree(spark):
    data = _random_changes(9)
    df = spark.createDataFrame(data, SCHEMA)
    a = cdc.scd2(df, ["k"], "seq", tiebreak=["tb"], track_columns=["a", "b"])
    b = cdc.scd2_windowed(df, ["k"], "seq", tiebreak=["tb"], track_columns=["a", "b"])
    assert _sorted(a) == _sorted(b) == brute_scd2(data, track=[3, 4])


def test_intervals_do_not_overlap_and_have_no_gaps(spark):
    # null sequences make degenerate (null-bounded) intervals; the invariant is
    # stated for real sequences, the brute-force tests cover the null case
    df = spark.createDataFrame([r for r in _random_changes(4) if r[1] is not None], SCHEMA)
    out = _sorted(cdc.scd2(df, ["k"], "seq", tiebreak=["tb"], track_columns=["a"], chunk=F.col("seq") % 1 + F.floor(F.col("seq") / 5)))
    by_key = {}
    for r in out:
        by_key.setdefault(r[0], []).append((r[5], r[6]))
    for iv in by_key.values():
        # versions with equal start sequences (told apart by the tiebreak) are
        # zero-length intervals; order by start, open end last
        iv.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1] is None, t[1] or 0))
        assert iv[-1][1] is None
        for (s1, e1), (s2, _) in zip(iv, iv[1:]):
            assert e1 == s2 and (s1 is None or s1 <= e1)


def test_type1_equals_open_version_of_type2(spark):
    df = spark.createDataFrame([r for r in _random_changes(5) if r[1] is not None], SCHEMA)
    t1 = cdc.scd1(df, ["k"], "seq", tiebreak=["tb"], columns=["a", "b"]).select("k", "seq", "tb", "a", "b")
    t2 = history.open_versions(cdc.scd2(df, ["k"], "seq", tiebreak=["tb"], track_columns=["a"]))
    key = lambda t: tuple((x is not None, x) for x in t)
    assert sorted(map(tuple, t1.collect()), key=key) == sorted(
        map(tuple, t2.select("k", "seq", "tb", "a", "b").collect()), key=key)


def test_any_permutation_gives_the_same_state(spark):
    data = _random_changes(6)
    shuffled = data[:]
    random.Random(0).shuffle(shuffled)
    a = cdc.scd2(spark.createDataFrame(data, SCHEMA).repartition(3), ["k"], "seq", tiebreak=["tb"], track_columns=["a"])
    b = cdc.scd2(spark.createDataFrame(shuffled, SCHEMA).repartition(5), ["k"], "seq", tiebreak=["tb"], track_columns=["a"])
    assert _sorted(a) == _sorted(b)


def test_ties_without_tiebreak_fail(spark):
    df = spark.createDataFrame([(1, 5, 0, "x", 1), (1, 5, 1, "y", 1)], SCHEMA)
    with pytest.raises(Exception, match="equal sequence"):
        cdc.scd2(df, ["k"], "seq", track_columns=["a"]).collect()
    with pytest.raises(Exception, match="equal sequence"):
        cdc.scd1(df, ["k"], "seq", columns=["a"]).collect()
    # identical rows at the same sequence are no conflict for type 1
    same = spark.createDataFrame([(1, 5, 0, "x", 1), (1, 5, 0, "x", 1)], SCHEMA)
    assert cdc.scd1(same, ["k"], "seq", columns=["a", "tb", "b"]).count() == 1


def test_type1_late_change_does_not_win(spark):
    state = spark.createDataFrame([(1, 10, 0, "new", 1)], SCHEMA)
    late = spark.createDataFrame([(1, 3, 0, "old", 1), (2, 1, 0, "z", 1)], SCHEMA)
    out = {r.k: r.a for r in cdc.scd1(late, ["k"], "seq", tiebreak=["tb"], columns=["a", "b"], target=state).collect()}
    assert out == {1: "new", 2: "z"}


def test_type1_delete_when(spark):
    df = spark.createDataFrame([(1, 1, 0, "x", 1), (1, 2, 0, "DELETE", 1), (2, 1, 0, "y", 1)], SCHEMA)
    out = cdc.scd1(df, ["k"], "seq", tiebreak=["tb"], columns=["a"], delete_when="a = 'DELETE'")
    assert [r.k for r in out.collect()] == [2]


@pytest.mark.parametrize("seed", [11, 12])
def test_hot_key_chunking_equals_brute_force(spark, seed):
    """Key 0 holds about a third of the rows; with a low threshold it is split
    into sequence chunks while the other keys stay whole."""
    data = _random_changes(seed, n=600)
    df = spark.createDataFrame(data, SCHEMA).withColumn("ts", F.timestamp_seconds(F.col("seq") * 1800))
    got = cdc.scd2(df, ["k"], "seq", tiebreak=["tb"], track_columns=["a"], columns=["seq", "tb", "a", "b"],
                   hot_key_rows=50)
    assert _sorted(got) == brute_scd2(data, track=[3])
    by_ts = cdc.scd2(df, ["k"], "ts", tiebreak=["tb"], track_columns=["a"], columns=["seq", "tb", "a", "b"],
                     hot_key_rows=50)
    assert by_ts.count() == len(brute_scd2(data, track=[3]))


def test_apply_changes_accepts_the_declarative_argument_names(spark):
    df = spark.createDataFrame([(1, 1, 0, "x", 1), (1, 2, 0, "y", 1), (1, 3, 0, "y", 2)], SCHEMA)
    a = cdc.apply_changes(df, ["k"], "seq", stored_as_scd_type=2, track_history_column_list=["a"],
                          columns=["a", "b"])
    b = cdc.apply_changes(df, ["k"], "seq", scd_type=2, track_columns=["a"], columns=["a", "b"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.count() == 2


def test_text_sequence_stamped_per_load(spark):
    """Loads stamp one text time on all their rows; tracking only that column
    opens one version per load, equal stamps need a tiebreak."""
    loads = ["2025-06-01 09:00:00", "2025-06-01 10:30:00", "2025-06-02 08:00:00"]
    rows = []
    i = 0
    for load in loads:
        for k in (1, 1, 2):
            rows.append((k, load, i, f"n{i}"))
            i += 1
    df = spark.createDataFrame(rows, "ID long, ProcessedDate string, rn long, Name string")
    with pytest.raises(Exception, match="equal sequence"):
        cdc.scd2(df, ["ID"], "ProcessedDate", track_columns=["ProcessedDate"]).collect()
    for kw in ({}, {"hot_key_rows": 2}):
        out = cdc.scd2(df, ["ID"], "ProcessedDate", track_columns=["ProcessedDate"], tiebreak=["rn"], **kw)
        got = sorted((r["ID"], r["__START_AT"], r["__END_AT"], r["Name"]) for r in out.collect())
        assert got == [
            (1, loads[0], loads[1], "n1"), (1, loads[1], loads[2], "n4"), (1, loads[2], None, "n7"),
            (2, loads[0], loads[1], "n2"), (2, loads[1], loads[2], "n5"), (2, loads[2], None, "n8"),
        ]
