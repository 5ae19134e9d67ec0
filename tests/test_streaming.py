"""Streams: exactly once per file, restart, replay, crash between steps, metrics, archive."""

from __future__ import annotations

import os
import re

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SMALL
from tidemark.operators import quality
from tidemark.plans.landing import EVENT_SCHEMA, land_events
from tidemark.streaming.ingest import append_stream, file_stream, run_available
from tidemark.streaming.state import BucketedState


def test_restart_on_same_checkpoint_adds_nothing(spark):
    root, landing = land_events(spark, SMALL, "t_restart")
    for _ in range(2):
        append_stream(file_stream(spark, landing, EVENT_SCHEMA), f"{root}/out", f"{root}/ck")
    n = spark.read.parquet(f"{root}/out").count()
    assert n == spark.read.parquet(f"{SMALL}/events.parquet").count()


def test_new_files_after_restart_are_picked_up_once(spark):
    root, landing = land_events(spark, SMALL, "t_more")
    append_stream(file_stream(spark, landing, EVENT_SCHEMA), f"{root}/out", f"{root}/ck")
    extra = spark.read.parquet(f"{SMALL}/events.parquet").limit(5)
    extra.write.mode("append").options(header="true", timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(landing)
    append_stream(file_stream(spark, landing, EVENT_SCHEMA), f"{root}/out", f"{root}/ck")
    n = spark.read.parquet(f"{root}/out").count()
    assert n == spark.read.parquet(f"{SMALL}/events.parquet").count() + 5


@pytest.mark.parametrize("file_rows,n_files", [(None, 3), (50, 6)])
def test_landed_files_and_micro_batches_follow_rows_not_tasks(spark, tmp_path, monkeypatch, file_rows, n_files):
    """Twelve tasks of events land as files of about ``FILE_ROWS``; the type 2
    stream has a micro-batch for each, and its snapshot is that of all events."""
    from tidemark.operators.cdc import scd2
    from tidemark.plans import landing
    from tidemark.streaming import cdc as scdc

    if file_rows:
        monkeypatch.setattr(landing, "FILE_ROWS", file_rows)
    n = F.col("event_id")
    ev = spark.range(300, numPartitions=12).toDF("event_id").select(
        n, F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, event_id)").alias("ts"),
        F.when(n % 11 != 0, n % 11).alias("user_id"), F.when(n % 7 != 0, (n % 5).cast("string")).alias("event_type"),
        (n / 4).alias("value"), F.lit(None).cast("string").alias("props"))
    place = landing.land(ev, str(tmp_path))
    assert len([f for f in os.listdir(place) if f.endswith(".csv")]) == n_files
    s = file_stream(spark, place, EVENT_SCHEMA, max_files_per_trigger=1)
    cols = [c for c in landing.EVENT_COLS if c != "user_id"]
    scdc.stream_scd2(s, str(tmp_path / "cdc"), str(tmp_path / "ck"), ["user_id"], "ts", track_columns=["event_type"],
                     tiebreak=["event_id"], columns=cols, n_buckets=2, current_root=str(tmp_path / "gold"))
    assert len([f for f in os.listdir(tmp_path / "gold" / "_commits") if not f.startswith(".")]) == n_files
    want = scd2(ev, ["user_id"], "ts", track_columns=["event_type"], tiebreak=["event_id"], columns=cols)
    shown = ["user_id", *cols, "__START_AT", "__END_AT"]
    key = lambda t: tuple((x is not None, x) for x in t)
    gold = spark.read.parquet(str(tmp_path / "gold" / "data")).select(*shown)
    assert (sorted(map(tuple, gold.collect()), key=key)
            == sorted(map(tuple, want.filter("__END_AT is null").select(*shown).collect()), key=key))


def _state(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    return BucketedState(str(tmp_path / "state"), ["k"], schema, n_buckets=4)


def test_replayed_batch_id_is_skipped(spark, tmp_path):
    st = _state(spark, tmp_path)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    st.apply(spark, 0, lambda: st.with_bucket(first))
    st.apply(spark, 0, lambda: st.with_bucket(spark.createDataFrame([(1, "WRONG")], "k long, v string")))
    assert sorted(tuple(r) for r in st.current(spark).collect()) == [(1, "a"), (2, "b")]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    st = _state(spark, tmp_path)
    base = spark.createDataFrame([(k, "v0") for k in range(40)], "k long, v string")
    st.apply(spark, 0, lambda: st.with_bucket(base))
    upd = st.with_bucket(spark.createDataFrame([(3, "v1")], "k long, v string"))
    bucket = upd.first()["__bucket"]
    same_bucket = st.read(spark, st.bucket_ids(upd)).drop("__bucket")
    plan = st.read(spark, [bucket])._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[isnotnull\(__bucket#\d+\), \(__bucket#\d+ = {bucket}\)\]", plan)
    new = same_bucket.filter(F.col("k") != 3).unionByName(upd.drop("__bucket"))
    st.apply(spark, 1, lambda: st.with_bucket(new))
    got = {r.k: r.v for r in st.current(spark).collect()}
    assert len(got) == 40 and got[3] == "v1" and sum(v == "v1" for v in got.values()) == 1
    others = [d for d in os.listdir(st.data) if d.startswith("__bucket=") and d != f"__bucket={bucket}"]
    assert others  # untouched partitions stay where they were


def test_crash_after_staging_redoes_from_staging(spark, tmp_path):
    st = _state(spark, tmp_path)
    staged = st.with_bucket(spark.createDataFrame([(7, "staged")], "k long, v string"))
    staged.write.partitionBy("__bucket").parquet(f"{st.root}/_staging/merge-5")  # crash before the move

    def must_not_run():
        raise AssertionError("recomputed although a complete staging copy exists")

    st.apply(spark, 5, must_not_run)
    assert [tuple(r) for r in st.current(spark).collect()] == [(7, "staged")]


def test_stream_metrics_by_observe(spark):
    root, landing = land_events(spark, SMALL, "t_metrics")
    s = file_stream(spark, landing, EVENT_SCHEMA)
    checked = quality.expect(s, {"value below 300": "value < 300"}, observation="rules")
    q = run_available(checked, f"{root}/ck", path=f"{root}/out")
    seen = [p["observedMetrics"]["rules"] for p in q.recentProgress if p.get("observedMetrics")]
    total = sum(m["rows"] for m in seen)
    failed = sum(m["failed:value below 300"] for m in seen)
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    assert total == ev.count()
    assert failed == ev.filter(~F.coalesce(F.col("value") < 300, F.lit(False))).count()


def test_archive_moves_processed_files(spark):
    root, landing = land_events(spark, SMALL, "t_archive")
    s = file_stream(spark, landing, EVENT_SCHEMA, max_files_per_trigger=1, clean_source="archive",
                    archive_dir=f"{root}/archive")
    append_stream(s, f"{root}/out", f"{root}/ck")
    archived = [f for _, _, fs in os.walk(f"{root}/archive") for f in fs if f.endswith(".csv")]
    assert archived  # archiving lags one batch behind, but files do move


def test_stream_scd2_late_change_and_null_key(spark, tmp_path):
    """A@1, A@3 arrive first, B@2 later: history must become A, B, A; a null
    key is a key like any other."""
    from tidemark.operators.cdc import scd2
    from tidemark.streaming.cdc import stream_scd2

    schema = "k long, seq long, v string"
    land = str(tmp_path / "land")
    first = spark.createDataFrame([(1, 1, "A"), (1, 3, "A"), (None, 1, "x")], schema)
    late = spark.createDataFrame([(1, 2, "B"), (None, 2, "y")], schema)
    for part in (first, late):
        part.coalesce(1).write.mode("append").option("header", True).csv(land)
    s = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", 1).csv(land)
    st = stream_scd2(s, str(tmp_path / "cdc"), str(tmp_path / "ck"), ["k"], "seq", track_columns=["v"], n_buckets=4)
    got = sorted(((r["k"], r["v"], r["__START_AT"], r["__END_AT"]) for r in st.current(spark).collect()),
                 key=lambda t: tuple((x is not None, x) for x in t))
    want = sorted(((r["k"], r["v"], r["__START_AT"], r["__END_AT"]) for r in
                   scd2(first.unionByName(late), ["k"], "seq", track_columns=["v"]).collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))
    assert got == want
    assert sorted((r[2], r[1], r[3]) for r in got if r[0] == 1) == [(1, "A", 2), (2, "B", 3), (3, "A", None)]


def test_incremental_stream_scd2_equals_batch_on_random_late_data(spark, tmp_path):
    """Five files of random changes arrive in shuffled sequence order; the
    incremental state must equal the batch history of all changes."""
    import random

    from tidemark.operators.cdc import scd2
    from tidemark.streaming.cdc import stream_scd2

    rnd = random.Random(7)
    rows = [(rnd.choice([1, 1, 1, 2, 3, None]), rnd.randrange(0, 200), i, rnd.choice(["x", "y"])) for i in range(300)]
    schema = "k long, seq long, tb long, v string"
    land = str(tmp_path / "land")
    for part in range(5):
        chunk = [r for j, r in enumerate(rows) if j % 5 == part]
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").option("header", True).csv(land)
    s = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", 1).csv(land)
    st = stream_scd2(s, str(tmp_path / "cdc"), str(tmp_path / "ck"), ["k"], "seq", tiebreak=["tb"],
                     track_columns=["v"], n_buckets=4)
    cols = ["k", "seq", "tb", "v", "__START_AT", "__END_AT"]
    key = lambda t: tuple((x is not None, x) for x in t)
    got = sorted((tuple(r[c] for c in cols) for r in st.current(spark).collect()), key=key)
    want = sorted((tuple(r[c] for c in cols) for r in
                   scd2(spark.createDataFrame(rows, schema), ["k"], "seq", tiebreak=["tb"], track_columns=["v"]).collect()),
                  key=key)
    assert got == want


@pytest.mark.parametrize("hot_key_rows", [None, 20])
def test_stream_scd2_moves_stored_and_logged_rows_once_a_batch(spark, tmp_path, monkeypatch, hot_key_rows):
    """Without a hot key, a micro-batch shuffles the log and the stored rows by
    key once, with one, ranges are used; history and snapshot are those of all changes."""
    from tidemark.operators.cdc import scd2
    from tidemark.streaming import cdc as scdc

    plans, apply = [], BucketedState.apply

    def spied(self, spark, batch_id, compute, **kw):
        def seen():
            out = compute()
            plans.append(out._jdf.queryExecution().executedPlan().toString())
            return out
        return apply(self, spark, batch_id, seen, **kw)

    monkeypatch.setattr(BucketedState, "apply", spied)
    if hot_key_rows:
        monkeypatch.setattr(scdc, "HOT_KEY_ROWS", hot_key_rows)
    rows = [(None if i % 7 == 6 else i % 7, i * 37 % 101, i, "xyz"[i * i % 3]) for i in range(210)]
    schema = "k long, seq long, tb long, v string"
    land = str(tmp_path / "land")
    for part in (2, 0, 1):
        spark.createDataFrame(rows[part::3], schema).coalesce(1).write.mode("append").option("header", True).csv(land)
    s = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", 1).csv(land)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        st = scdc.stream_scd2(s, str(tmp_path / "cdc"), str(tmp_path / "ck"), ["k"], "seq", tiebreak=["tb"],
                              track_columns=["v"], n_buckets=4, current_root=str(tmp_path / "gold"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    cols = ["k", "seq", "tb", "v", "__START_AT", "__END_AT"]
    key = lambda t: tuple((x is not None, x) for x in t)
    got = sorted((tuple(r[c] for c in cols) for r in st.current(spark).collect()), key=key)
    want = sorted((tuple(r[c] for c in cols) for r in
                   scd2(spark.createDataFrame(rows, schema), ["k"], "seq", tiebreak=["tb"], track_columns=["v"]).collect()),
                  key=key)
    gold = sorted((tuple(r[c] for c in cols) for r in spark.read.parquet(str(tmp_path / "gold" / "data")).collect()), key=key)
    assert got == want and gold == [r for r in want if r[-1] is None] and len(plans) == 6
    if hot_key_rows is None:
        # the history: log, stored rows, and the batch's keys for either; the snapshot: nothing by key
        assert [p.count("Exchange hashpartitioning") for p in plans[-2:]] == [4, 0]


def test_stream_scd1_deletes_and_emptied_bucket(spark, tmp_path):
    from tidemark.streaming.cdc import stream_scd1

    schema = "k long, seq long, v string, op string"
    land = str(tmp_path / "land")
    first = spark.createDataFrame([(k, 1, f"a{k}", "upsert") for k in range(20)], schema)
    second = spark.createDataFrame([(k, 2, None, "delete") for k in range(20) if k != 7]
                                   + [(7, 0, "late", "upsert")], schema)
    for part in (first, second):
        part.coalesce(1).write.mode("append").option("header", True).csv(land)
    s = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", 1).csv(land)
    st = stream_scd1(s, str(tmp_path / "st"), str(tmp_path / "ck"), ["k"], "seq", columns=["v"],
                     delete_when="op = 'delete'", n_buckets=4)
    got = [(r.k, r.v) for r in st.current(spark).collect()]
    assert got == [(7, "a7")]  # deletes won, the late upsert lost


def test_bucket_that_comes_out_empty_is_removed(spark, tmp_path):
    st = _state(spark, tmp_path)
    base = st.with_bucket(spark.createDataFrame([(k, "v") for k in range(20)], "k long, v string"))
    st.apply(spark, 0, lambda: base, touched=st.bucket_ids(base))
    victim = base.first()["__bucket"]
    rest = base.filter(f"__bucket <> {victim}")
    # batch 1 replaces bucket `victim` with nothing (every key in it deleted)
    st.apply(spark, 1, lambda: rest.limit(0), touched=[victim])
    assert f"__bucket={victim}" not in os.listdir(st.data)
    assert st.current(spark).count() == rest.count()


def test_bucketed_commits_carry_metrics(spark, tmp_path):
    from tidemark.operators.audit import metrics_pivot

    st = _state(spark, tmp_path)
    base = spark.createDataFrame([(k, "v") for k in range(10)], "k long, v string")
    keyed = st.with_bucket(base)
    st.apply(spark, 0, lambda: keyed, touched=st.bucket_ids(keyed))
    log = {r.version: r.operation_metrics for r in st.commit_log(spark).collect()}
    assert log["merge-0"]["numOutputRows"] == "10" and int(log["merge-0"]["numTouchedBuckets"]) >= 1
    piv = metrics_pivot(st.commit_log(spark), metrics=["numOutputRows"]).collect()
    assert piv[0].numOutputRows == 10


def test_stream_scd1_late_change_cannot_revive_a_deleted_key(spark, tmp_path):
    from tidemark.streaming.cdc import stream_scd1

    schema = "k long, seq long, v string, op string"
    land = str(tmp_path / "land")
    files_in_order = [
        [(1, 1, "a", "upsert"), (2, 1, "b", "upsert")],
        [(1, 5, None, "delete")],
        [(1, 3, "late", "upsert"), (2, 9, "b2", "upsert")],   # late and older than the delete
    ]
    for rows_ in files_in_order:
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").option("header", True).csv(land)
    s = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", 1).csv(land)
    st = stream_scd1(s, str(tmp_path / "st"), str(tmp_path / "ck"), ["k"], "seq", columns=["v"],
                     delete_when="op = 'delete'", n_buckets=2)
    assert sorted((r.k, r.v) for r in st.current(spark).collect()) == [(2, "b2")]


def test_purge_old_tombstones(spark, tmp_path):
    from tidemark.streaming.cdc import purge_tombstones, stream_scd1

    schema = "k long, seq long, v string, op string"
    land = str(tmp_path / "land")
    for rows_ in ([(1, 1, "a", "upsert"), (2, 1, "b", "upsert")], [(1, 5, None, "delete")]):
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").option("header", True).csv(land)
    s = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", 1).csv(land)
    st = stream_scd1(s, str(tmp_path / "st"), str(tmp_path / "ck"), ["k"], "seq", columns=["v"],
                     delete_when="op = 'delete'", n_buckets=2)
    assert st.read(spark).filter("__deleted").count() == 1
    purge_tombstones(spark, st, "seq", 3, batch_id=1000)      # tombstone at seq 5 is still young
    assert st.read(spark).filter("__deleted").count() == 1
    purge_tombstones(spark, st, "seq", 10, batch_id=1001)
    assert st.read(spark).filter("__deleted").count() == 0
    assert sorted((r.k, r.v) for r in st.current(spark).collect()) == [(2, "b")]


def test_merge_in_place_replay_is_skipped(spark, tmp_path):
    from tidemark.operators import merge
    from tidemark.streaming.state import load, merge_in_place

    st = _state(spark, tmp_path)
    load(spark, st, spark.createDataFrame([(k, "v0") for k in range(10)], "k long, v string"), batch_id=0)
    merge_in_place(spark, st, spark.createDataFrame([(3, "v1"), (42, "new")], "k long, v string"),
                   merge.upsert_all, 1, keys=["k"])
    after_first = sorted(map(tuple, st.current(spark).collect()))
    merge_in_place(spark, st, spark.createDataFrame([(3, "WRONG")], "k long, v string"),
                   merge.upsert_all, 1, keys=["k"])
    assert sorted(map(tuple, st.current(spark).collect())) == after_first
    assert (3, "v1") in after_first and (42, "new") in after_first and len(after_first) == 11


def test_merge_with_other_key_type_keeps_every_row(spark, tmp_path):
    from tidemark.operators.merge import upsert_all
    from tidemark.streaming.state import load, merge_in_place

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    st = BucketedState(str(tmp_path / "typed"), ["k"], schema, n_buckets=8)
    load(spark, st, spark.createDataFrame([(k, "old") for k in range(100)], schema))
    merge_in_place(spark, st, spark.createDataFrame([(1, "a"), (2, "b"), (500, "c")], "k int, v string"), upsert_all, 0, keys=["k"])
    got = {r.k: r.v for r in st.current(spark).collect()}
    assert len(got) == 101 and got[1] == "a" and got[500] == "c" and got[3] == "old"
    with pytest.raises(Exception, match="does not fit"):
        merge_in_place(spark, st, spark.createDataFrame([("x", "a")], "k string, v string"), upsert_all, 1, keys=["k"])
    assert st.current(spark).count() == 101


def test_layout_is_stored_and_enforced(spark, tmp_path):
    from tidemark.streaming.state import load

    st = _state(spark, tmp_path)
    load(spark, st, spark.createDataFrame([(k, "v") for k in range(20)], "k long, v string"))
    other = BucketedState(st.root, ["k"], st.schema, n_buckets=16)
    with pytest.raises(ValueError, match="was written as"):
        other.read(spark)
    with pytest.raises(ValueError, match="was written as"):
        load(spark, other, spark.createDataFrame([(1, "w")], "k long, v string"), batch_id=3)


def test_loads_and_streams_do_not_take_each_others_batch_ids(spark, tmp_path):
    from tidemark.operators.merge import upsert_all
    from tidemark.streaming.cdc import stream_merge
    from tidemark.streaming.state import load

    st = _state(spark, tmp_path)
    load(spark, st, spark.createDataFrame([(k, "loaded") for k in range(5)], "k long, v string"))
    for n in (1, 2):  # the second stream has a new checkpoint on the same table
        spark.createDataFrame([(10 * n + k, f"s{n}") for k in range(5)], "k long, v string").write.parquet(str(tmp_path / f"in{n}"))
        stream = spark.readStream.schema("k long, v string").parquet(str(tmp_path / f"in{n}"))
        stream_merge(stream, st, str(tmp_path / f"ckpt{n}"), upsert_all, keys=["k"])
    assert st.current(spark).count() == 15


def test_a_result_outside_the_touched_buckets_is_refused(spark, tmp_path):
    st = _state(spark, tmp_path)
    base = st.with_bucket(spark.createDataFrame([(k, "v") for k in range(20)], "k long, v string"))
    st.apply(spark, 0, lambda: base, touched=st.bucket_ids(base))
    with pytest.raises(RuntimeError, match="does not touch"):
        st.apply(spark, 1, lambda: base, touched=[0])
    assert st.current(spark).count() == 20


STEPS = ["bronze", "state staging", "state move", "state commit", "gold staging", "gold move", "gold commit"]


@pytest.mark.parametrize("step", STEPS)
def test_stream_scd2_with_snapshot_survives_a_crash_at_every_step(spark, tmp_path, monkeypatch, step):
    """The second of two files dies at ``step``; after a restart on the same checkpoint, history and
    snapshot are those of all changes."""
    from pyspark.sql.readwriter import DataFrameWriter

    from tidemark.operators.cdc import scd2
    from tidemark.streaming import state as st_module
    from tidemark.streaming.cdc import stream_scd2

    schema = "k long, seq long, v string"
    parts = [[(k, s, f"v{(k + s) % 2}") for k in range(6) for s in (4 * f, 4 * f + 2)] for f in (1, 0)]
    land = str(tmp_path / "land")
    for rows_ in parts:
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").option("header", True).csv(land)

    def run():
        s = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", 1).csv(land)
        return stream_scd2(s, str(tmp_path / "cdc"), str(tmp_path / "ck"), ["k"], "seq", track_columns=["v"],
                           n_buckets=4, current_root=str(tmp_path / "gold"))

    class Crash(Exception):
        pass

    where = {"bronze": "/bronze", "state": "/cdc/state", "gold": "/gold"}[step.split()[0]]
    kind = step.split()[-1]
    parquet, text, seen = DataFrameWriter.parquet, st_module._write_text, []

    def dying_parquet(self, path, *a, **b):
        out = parquet(self, path, *a, **b)
        if kind in ("bronze", "staging") and where in path and ("_staging" in path) == (kind == "staging"):
            seen.append(path)
            if len(seen) == 2:
                raise Crash(step)
        return out

    def dying_text(spark_, path, content):
        if where in path and kind in ("move", "commit") and ("_EMPTY" if kind == "move" else "_commits") in path:
            seen.append(path)
            if len(seen) == 2:
                raise Crash(step)
        return text(spark_, path, content)

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", dying_parquet)
        m.setattr(st_module, "_write_text", dying_text)
        with pytest.raises(Exception, match="Crash"):
            run()
    assert len(seen) == 2
    st = run()
    cols = ["k", "seq", "v", "__START_AT", "__END_AT"]
    key = lambda t: tuple((x is not None, x) for x in t)
    want = sorted((tuple(r[c] for c in cols) for r in
                   scd2(spark.createDataFrame(sum(parts, []), schema), ["k"], "seq", track_columns=["v"]).collect()), key=key)
    assert sorted((tuple(r[c] for c in cols) for r in st.current(spark).collect()), key=key) == want
    gold = spark.read.parquet(str(tmp_path / "gold" / "data"))
    assert sorted((tuple(r[c] for c in cols) for r in gold.collect()), key=key) == [r for r in want if r[-1] is None]


def test_commits_of_two_writers_keep_their_counts_also_after_a_crash(spark, tmp_path, monkeypatch):
    from tidemark.operators.audit import metrics_pivot
    from tidemark.operators.merge import upsert_mapped
    from tidemark.streaming import state as st_module
    from tidemark.streaming.state import load, merge_in_place

    st = _state(spark, tmp_path)
    load(spark, st, spark.createDataFrame([(k, "v0") for k in range(10)], "k long, v string"))

    def merge(rows_, writer):
        merge_in_place(spark, st, spark.createDataFrame(rows_, "k long, v string"), upsert_mapped, 0, writer=writer, keys=["k"],
                       update_set={"v": "s.v"}, insert_values={"k": "s.k", "v": "s.v"}, delete_condition="s.v = 'gone'")

    merge([(1, "a"), (2, "gone"), (77, "new")], "hr")
    text = st_module._write_text
    with monkeypatch.context() as m:  # dies before anything moves; the second try must not compute again
        m.setattr(st_module, "_write_text", lambda s, p, t: (_ for _ in ()).throw(OSError("lost")) if "_EMPTY" in p else text(s, p, t))
        with pytest.raises(OSError):
            merge([(3, "b"), (4, "c")], "payroll")
    merge([(3, "b"), (4, "c")], "payroll")
    got = {r.version: (r.numTargetRowsInserted, r.numTargetRowsUpdated, r.numTargetRowsDeleted, r.user_name)
           for r in metrics_pivot(st.commit_log(spark), missing=None).collect()}
    assert got == {"load-0": (None, None, None, "load"), "hr-0": (1, 1, 1, "hr"), "payroll-0": (0, 2, 0, "payroll")}
