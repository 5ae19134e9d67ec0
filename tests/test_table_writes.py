"""Writes that count, gate, split and check: intake, export parts, contracts, later runs of history, fingerprints."""

from __future__ import annotations

import csv
import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fingerprints, history, intake, publish
from tidemark.operators.contract import ContractTable
from tidemark.operators.diff import classify_changes
from tidemark.operators.intake import Intake, NothingAccepted
from tidemark.streaming.ingest import run_available

# ------------------------------------------------------------------ intake


def routed(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, route string")


def test_intake_writes_every_route_once_and_counts_it(spark, tmp_path):
    box = Intake(str(tmp_path / "in"))
    rows = routed(spark, (1, "accepted"), (2, "accepted"), (3, "rejected"))
    assert box.write(rows, "a") == {"accepted": 2, "rejected": 1, "ignored": 0}
    assert box.write(routed(spark, (9, "accepted")), "a") == {"accepted": 2, "rejected": 1, "ignored": 0}  # a replay
    box.write(routed(spark, (4, "accepted")), "b")
    assert sorted((r.id, r.run) for r in box.read(spark, "accepted", rows.schema).collect()) == [(1, "a"), (2, "a"), (4, "b")]
    assert [r.id for r in box.read(spark, "rejected", rows.schema).collect()] == [3]
    assert box.read(spark, "ignored", rows.schema).collect() == []


def test_a_run_without_accepted_rows_stops_and_shows_nothing(spark, tmp_path):
    box = Intake(str(tmp_path / "in"))
    rows = routed(spark, (1, "rejected"), (2, "ignored"))
    with pytest.raises(NothingAccepted) as stop:
        box.write(rows, "a")
    assert stop.value.counts == {"accepted": 0, "rejected": 1, "ignored": 1}
    assert box.outcome(spark, "a") is None and box.read(spark, "rejected", rows.schema).collect() == []
    with pytest.raises(Exception, match="no such route"):
        box.write(routed(spark, (1, "accepted"), (2, None)), "b")


@pytest.mark.parametrize("at", ["_COUNTS", "_runs"])
def test_a_crashed_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, at):
    box, rows = Intake(str(tmp_path / "in")), routed(spark, (1, "accepted"), (2, "rejected"))
    text = intake._write_text

    def dies(s, path, content):
        if at in path:
            raise OSError("lost")
        return text(s, path, content)

    with monkeypatch.context() as m:
        m.setattr(intake, "_write_text", dies)
        with pytest.raises(OSError):
            box.write(rows, "a")
    assert box.read(spark, "accepted", rows.schema).collect() == []
    assert box.write(rows, "a") == {"accepted": 1, "rejected": 1, "ignored": 0}
    assert [r.id for r in box.read(spark, "rejected", rows.schema).collect()] == [2]


# ------------------------------------------------------------------ export parts


def test_parts_are_bounded_ordered_named_and_whole(spark, tmp_path):
    r = random.Random(1)
    data = [(r.randrange(50), i, r.choice(["a", "b,c", 'd"e', None])) for i in range(1003)]
    df = spark.createDataFrame(data, "k int, i int, s string").repartition(6)
    folder = str(tmp_path / "out")
    files = publish.export_parts(df, folder, ["k", "i"], 100, name="emp")
    assert [os.path.basename(f) for f in files] == [f"emp_{n:06d}.csv" for n in range(11)]
    read = []
    for f in files:
        with open(f, newline="") as lines:
            part = list(csv.reader(lines, escapechar="\\"))
        assert part[0] == ["k", "i", "s"] and len(part) - 1 == (100 if f != files[-1] else 3)
        read += [(int(k), int(i), s or None) for k, i, s in part[1:]]
    assert read == sorted(data)
    assert json.loads((tmp_path / "out" / "_PARTS").read_text())["rows"] == 1003
    publish.export_parts(df.limit(5), folder, ["k", "i"], 100, name="emp")  # a shorter export leaves no old part
    assert sorted(f for f in os.listdir(folder) if f.endswith(".csv")) == ["emp_000000.csv"]
    assert publish.export_parts(df.limit(0), folder, ["k"], 100, name="none") == []


# ------------------------------------------------------------------ contracts

DDL = "id bigint not null, name string not null, dob int"


def test_a_bad_batch_leaves_the_table_as_it_was(spark, tmp_path):
    t = ContractTable.create(spark, str(tmp_path / "t"), DDL)
    assert t.read().collect() == []
    t.append(spark.createDataFrame([("a", 1), ("b", 2)], "NAME string, id int"))  # by name, cast, dob missing
    before = sorted(os.listdir(t.data))
    for bad in ([(None, 3), ("c", 4)], [("x", None)]):
        with pytest.raises(Exception, match="is not null"):
            t.append(spark.createDataFrame(bad, "name string, id int").repartition(2))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        t.append(spark.createDataFrame([("n", "seven")], "name string, id string"))
    assert sorted(f for f in os.listdir(t.data) if "_temporary" not in f) == before
    assert sorted(map(tuple, t.read().collect())) == [(1, "a", None), (2, "b", None)]
    with pytest.raises(ValueError, match="missing"):
        t.append(spark.createDataFrame([(1,)], "id int"))
    with pytest.raises(ValueError, match="unknown"):
        t.append(spark.createDataFrame([(1, "a", 2)], "id int, name string, extra int"))


def test_contracts_are_stored_and_hold_for_streams(spark, tmp_path):
    root = str(tmp_path / "t")
    ContractTable.create(spark, root, DDL)
    assert ContractTable.create(spark, root, DDL).schema == ContractTable.open(spark, root).schema
    with pytest.raises(ValueError, match="has the contract"):
        ContractTable.create(spark, root, "id bigint")
    t, land = ContractTable.open(spark, root), str(tmp_path / "land")
    spark.createDataFrame([(1, "a", 2)], "id long, name string, dob int").write.mode("append").parquet(land)
    stream = spark.readStream.schema("id long, name string, dob int").parquet(land)
    t.append_stream(stream, str(tmp_path / "ck"))
    spark.createDataFrame([(2, None, 2)], "id long, name string, dob int").write.mode("append").parquet(land)
    with pytest.raises(Exception, match="is not null"):
        t.append_stream(stream, str(tmp_path / "ck"))
    assert [r.id for r in t.read().collect()] == [1]
    new = ContractTable.create(spark, root, "id bigint not null", replace=True)
    assert new.read().collect() == [] and new.read().columns == ["id"]


# ------------------------------------------------------------------ versioned history, later runs

T0 = dt.datetime(2024, 1, 1)
V = "id int, name string, mobile string, version int, datetime timestamp_ntz, status string"


def versions(df):
    return sorted((r.id, r.version, r.status, r.name, r.mobile) for r in df.collect())


def test_later_runs_of_the_versioned_history(spark):
    t = spark.createDataFrame([(1, "a1", None, 0, T0, "Active"), (1, "a0", "x", 1, T0, "InActive"),
                               (2, "b1", "y", 0, T0, "Active"), (5, "e0", "z", 1, T0, "InActive")], V)
    b = [spark.createDataFrame(rows, "id int, name string, mobile string") for rows in (
        [(1, "a2", "p"), (3, "c1", "q")], [(1, "a3", None), (3, "c1", "q"), (3, "c1", "q")], [(4, "d1", "r"), (5, "e1", "s")])]
    run = "2024-02-01 00:00:00"
    whole = history.versioned_history_runs(t, b, run_ts=run)
    assert versions(whole) == [
        (1, 0, "Active", "a3", None), (1, 1, "InActive", "a2", "p"), (2, 0, "Active", "b1", "y"),
        (3, 0, "Active", "c1", "q"), (3, 1, "InActive", "c1", "q"), (4, 0, "Active", "d1", "r"),
        (5, 0, "Active", "e1", "s"), (5, 1, "InActive", "e0", "z")]
    assert {r.datetime for r in whole.collect()} == {dt.datetime(2024, 2, 1)}
    step = t
    for one in b:  # run by run, on its own output
        step = history.versioned_history_runs(step, [one], run_ts=run)
    assert versions(step) == versions(whole)
    first = spark.createDataFrame([(1, "a1", None, 0, T0, "Active")], V)
    assert versions(history.versioned_history_runs(first, b[:1], run_ts=run)) == \
        versions(history.versioned_history_merge(first, b[0], run_ts=run))
    assert versions(history.versioned_history_runs(t, [b[0].limit(0)], run_ts=run)) == versions(t)


@pytest.mark.parametrize("rows, batch, message", [
    ([(1, "a", "x", 0, T0, "Active"), (1, "b", "x", 0, T0, "Active")], [(1, "c", "d")], "several rows of one status"),
    ([(1, "a", "x", 2, T0, "InActive")], [(1, "c", "d")], "unknown version"),
    ([(1, "a", "x", 0, T0, "Active")], [(1, "c", "d"), (1, "e", "d")], "several different rows")])
def test_conflicting_groups_fail(spark, rows, batch, message):
    with pytest.raises(Exception, match=message):
        history.versioned_history_runs(spark.createDataFrame(rows, V), [spark.createDataFrame(
            batch, "id int, name string, mobile string")], run_ts="2024-02-01 00:00:00").collect()


# ------------------------------------------------------------------ fingerprints


def test_fingerprints_find_what_the_wide_comparison_finds(spark, tmp_path):
    r = random.Random(5)
    val = lambda: r.choice([None, "a", "b"])
    t = [(i, val(), val(), r.choice([None, 1, 2])) for i in range(300)]
    b = [(i, val(), val(), r.choice([None, 1, 2])) for i in range(100, 420)] + [(None, "a", "b", 1), (100, "dup", None, 2)]
    spark.createDataFrame(t, "id int, x string, y string, z bigint").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame(b, "id int, x string, y string, z int")  # another type than the table's
    fingerprints.fingerprints(table, ["id"], ["x", "y", "z"]).write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    got = fingerprints.changed_by_fingerprint(table, stored, batch, ["id"], ["x", "y", "z"])
    want = classify_changes(table, batch, ["id"], ["x", "y", "z"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # the table is read for doubtful keys only, behind the fingerprints' join
    joined = plan.split("LeftSemi")
    assert len(joined) > 1 and plan.count("x#") and "__f1" in plan


def test_swapped_nulls_have_other_fingerprints(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "a")], "id int, x string, y string")
    a, b = fingerprints.fingerprints(df, ["id"], ["x", "y"]).collect()
    assert (a["__f1"], a["__f2"]) != (b["__f1"], b["__f2"])


# ------------------------------------------------------------------ mergeable profile


def test_merged_sketches_equal_one_pass_and_estimate_within_bounds(spark):
    from tidemark.operators.sketches import merge_profiles, report, sketch_profile

    df = spark.range(30_000).selectExpr("id % 7001 as i", "cast(id as double) * 1e6 + 1e9 as x", "concat('s', id % 500) as s",
                                        "if(id % 10 = 0, null, cast(id % 100 as int)) as n", "cast(null as double) as e")
    parts = [sketch_profile(df.filter(f"pmod(xxhash64(i, x), 5) = {k}")) for k in range(5)]
    nested = merge_profiles(parts[0].unionByName(parts[1])).unionByName(merge_profiles(parts[2].unionByName(parts[3]))).unionByName(parts[4])
    got = {r.column_name: r for r in report(nested).collect()}
    one = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("i", "x", "n") for f in (F.avg, F.stddev_samp)]).first()
    for c in ("i", "x", "n"):
        assert got[c].mean == pytest.approx(one[f"avg_{c}"], rel=1e-12)
        assert got[c].stddev == pytest.approx(one[f"stddev_samp_{c}"], rel=1e-9)
    assert (got["i"].min_value, got["i"].max_value, got["n"].n_nulls, got["e"].n_nulls) == ("0", "7000", 3000, 30_000)
    assert (got["s"].min_value, got["s"].mean, got["e"].mean, got["e"].approx_quantiles) == ("s0", None, None, None)
    for c, n in (("i", 7001), ("x", 30_000), ("s", 500), ("n", 90)):
        assert abs(got[c].approx_distinct - n) <= 0.03 * n
    for q, v in zip((0.25, 0.5, 0.75), got["x"].approx_quantiles):
        assert abs((v - 1e9) / 1e6 - q * 30_000) <= 0.02 * 30_000


# ------------------------------------------------------------------ streams


def test_expectation_log_has_one_row_per_batch_and_rule(spark, tmp_path):
    from tidemark.operators import quality
    from tidemark.streaming.metrics import keep_expectations, read_expectations

    land, log = str(tmp_path / "land"), str(tmp_path / "log")
    schema, rules = "id long, v long", {"v positive": "v > 0", "id odd": "id % 2 = 1"}
    fail = {"on": True}

    def sink(batch, batch_id):
        batch.count()
        if batch_id == 1 and fail.pop("on", False):
            raise RuntimeError("lost")

    for n, ids in enumerate(((1, 2, 3), (4, 5))):
        spark.createDataFrame([(i, i - 2) for i in ids], schema).write.mode("append").parquet(land)
        for _ in range(2):  # the second file's first try dies after its metrics were seen
            with keep_expectations(spark, log):
                s = quality.expect(spark.readStream.schema(schema).parquet(land), rules, observation="rules")
                try:
                    run_available(s, str(tmp_path / "ck"), sink=sink)
                except Exception as e:  # noqa: BLE001
                    assert "lost" in str(e) and n == 1
    got = sorted((r.batch_id, r.rule, r.n_rows, r.n_failed) for r in read_expectations(spark, log).collect())
    assert got == [(0, "id odd", 3, 1), (0, "v positive", 3, 2), (1, "id odd", 2, 1), (1, "v positive", 2, 0)]


def test_keyed_state_keeps_the_latest_row_deletes_and_null_keys(spark, tmp_path):
    from tidemark.streaming import keyed

    schema = "k long, seq long, v string, op string"
    land, ck = str(tmp_path / "land"), str(tmp_path / "ck")
    for part in ([(1, 1, "a", "u"), (2, 1, "b", "u"), (None, 1, "n", "u"), (1, 4, "a4", "u")], [(1, 5, None, "d"), (2, None, "old", "u")],
                 [(1, 3, "late", "u"), (2, 9, "b9", "u"), (2, 8, "b8", "u"), (None, 0, "late", "u"), (3, 1, "c", "u")]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(land)
        s = spark.readStream.schema(schema).parquet(land)  # every load is a restart
        keyed.stream_scd1_stateful(s, str(tmp_path / "t"), ck, ["k"], "seq", columns=["v"], delete_when="op = 'd'")
    got = sorted(((r.k, r.seq, r.v) for r in keyed.current(spark, ck).collect()), key=str)
    assert got == [(2, 9, "b9"), (3, 1, "c"), (None, 1, "n")]
    changes = spark.read.parquet(str(tmp_path / "t" / "changes"))
    assert sorted((r.k, r.v) for r in changes.filter("batch = 2").collect()) == [(2, "b9"), (3, "c")]
