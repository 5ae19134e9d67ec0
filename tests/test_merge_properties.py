"""Randomised merges against plain-Python models of their contracts."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tidemark.operators import history, merge

RUN = dt.datetime(2024, 2, 1)
FAR = dt.datetime(9999, 12, 31)
T0 = dt.datetime(2024, 1, 1)
OLD = dt.datetime(2023, 1, 1)
SCHEMA = ("id long, name string, eskey int, status string, start_date timestamp_ntz, end_date timestamp_ntz, "
          "file_name string, created_date timestamp_ntz")


def _key(t):
    return tuple((x is not None, x) for x in t)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("broadcast", [True, False])
def test_upsert_all_model(spark, seed, broadcast):
    rnd = random.Random(seed)
    target = {i: rnd.choice(["a", "b", None]) for i in rnd.sample(range(100), 60)}
    source = {i: rnd.choice(["a", "c", None]) for i in rnd.sample(range(150), 40)}
    want = dict(target)
    want.update(source)
    t = spark.createDataFrame(sorted(target.items()), "id long, v string")
    s = spark.createDataFrame(sorted(source.items()), "id long, v string")
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.id: r.v for r in merge.upsert_all(t, s, ["id"]).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want


def _model_two_version(target_rows, batch_rows):
    """Contract lines 1-5 of the two-version merge, compat semantics."""
    by_id = {}
    for r in target_rows:
        by_id.setdefault(r[0], {})[r[3]] = r
    out = []
    batch = {b[0]: b for b in batch_rows}
    for i in sorted(set(by_id) | set(batch)):
        rows = by_id.get(i, {})
        a, old = rows.get("Active"), rows.get("InActive")
        b = batch.get(i)
        if b is None or (a is None and old is not None):
            out.extend(rows.values())
        elif not rows:
            out.append((i, b[1], 0, "Active", RUN, FAR, b[2], RUN))
        elif old is not None or a[1] != b[1] or a[6] != b[2]:
            out.append((i, b[1], 0, "Active", a[4], a[5], b[2], RUN))
            out.append((i, a[1], 1, "InActive", old[4] if old else a[4], old[5] if old else RUN, a[6], RUN))
        else:
            out.extend(rows.values())
    return sorted(out, key=_key)


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_two_version_compat_model(spark, seed):
    rnd = random.Random(seed)
    target_rows = []
    for i in range(80):
        kind = rnd.random()
        if kind < 0.6:
            target_rows.append((i, rnd.choice("xy"), 0, "Active", T0, FAR, "f1", T0))
        if 0.3 < kind < 0.8:
            target_rows.append((i, rnd.choice("xy"), 1, "InActive", OLD, T0, "f0", T0))
    batch_rows = [(i, rnd.choice("xyz"), rnd.choice(["f1", "f2"])) for i in rnd.sample(range(120), 60)]
    t = spark.createDataFrame(target_rows, SCHEMA)
    b = spark.createDataFrame(batch_rows, "id long, name string, file_name string")
    got = history.two_version_merge(t, b, values=["name"], run_ts="2024-02-01 00:00:00", compat=True)
    assert sorted(map(tuple, got.collect()), key=_key) == _model_two_version(target_rows, batch_rows)


@pytest.mark.parametrize("seed", [7, 8])
def test_versioned_history_model(spark, seed):
    """M-08: touched keys get version 1 (old) + 0 (batch); new keys 0; others
    keep their row; every row is restamped."""
    rnd = random.Random(seed)
    target = {i: rnd.choice(["a", "b"]) for i in rnd.sample(range(60), 30)}
    batch = {i: rnd.choice(["a", "c"]) for i in rnd.sample(range(90), 30)}
    want = []
    for i, v in target.items():
        if i in batch:
            want += [(i, batch[i], 0, "Active"), (i, v, 1, "InActive")]
        else:
            want.append((i, v, 0, "Active"))
    want += [(i, v, 0, "Active") for i, v in batch.items() if i not in target]
    schema = "id long, name string, mobile string, version int, datetime timestamp_ntz, status string"
    t = spark.createDataFrame([(i, v, "m", 0, T0, "Active") for i, v in target.items()], schema)
    b = spark.createDataFrame([(i, v, "m") for i, v in batch.items()], "id long, name string, mobile string")
    out = history.versioned_history_merge(t, b, run_ts="2024-02-01 00:00:00")
    got = sorted((r.id, r.name, r.version, r.status) for r in out.collect())
    assert got == sorted(want)
    assert {r.datetime for r in out.collect()} == {RUN}


@pytest.mark.parametrize("seed", [9, 10])
def test_merge_delete_and_classify_model(spark, seed):
    from tidemark.operators import diff

    rnd = random.Random(seed)
    target = [(i, rnd.choice(["Active", "InActive"]), rnd.choice(["x", "y", None])) for i in rnd.sample(range(80), 50)]
    batch = {i: rnd.choice(["x", "y", None]) for i in rnd.sample(range(120), 40)}
    t = spark.createDataFrame(target, "id long, status string, v string")
    b = spark.createDataFrame(sorted(batch.items()), "id long, v string")
    kept = sorted(tuple(r) for r in merge.merge_delete(t, b, ["id"], "status = 'InActive'").collect())
    assert kept == sorted(r for r in target if not (r[1] == "InActive" and r[0] in batch))
    active = {r[0]: r[2] for r in target if r[1] == "Active"}
    want = {}
    for i, v in batch.items():
        want[i] = "new" if i not in active else ("unchanged" if active[i] == v else "update")
    for i in active:
        want.setdefault(i, "missing")
    got = {r.id: r.change for r in diff.classify_changes(t.filter("status = 'Active'"), b, ["id"], ["v"]).collect()}
    assert got == want
