"""Plan shapes: shuffles, pushdown, no Python on the hot path."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.operators import cdc, diff, history, merge
from tidemark.operators.filters import stacked_filters
from tidemark.plans.all import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", _plan(df)))


def _emp_files(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    tgt = spark.createDataFrame(
        [(i, "a", 1990, "F", "X", "e", 0, "Active", t0, t0, "f", t0) for i in range(200)],
        "id long, name string, dob int, gender string, country string, email string, eskey int, status string, "
        "start_date timestamp_ntz, end_date timestamp_ntz, file_name string, created_date timestamp_ntz")
    bat = spark.createDataFrame([(1, "b", 1990, "F", "X", "e", "g"), (500, "n", 1990, "F", "X", "e", "g")],
                                "id long, name string, dob int, gender string, country string, email string, "
                                "file_name string")
    tgt.write.parquet(str(tmp_path / "t"))
    bat.write.parquet(str(tmp_path / "b"))
    return spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "b"))


def _final(df) -> str:
    """The plan that ran, with whole paths and schemas."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def _reads(plan: str, folder) -> list[str]:
    """The columns of each read of a table."""
    return re.findall(rf"FileScan parquet \[[^\n]*{re.escape(str(folder))}[^\n]*ReadSchema: struct<([^>]*)>", plan)


def test_small_batch_merge_reads_the_target_twice_and_never_shuffles_it(spark, tmp_path):
    """The batch is the build side of every join with the target; an upsert's second read is of the keys only."""
    target, batch = _emp_files(spark, tmp_path)
    out = history.two_version_merge(target, batch, run_ts="2024-02-01 00:00:00")
    plan = _final(out)
    assert "LeftSemi, BuildRight" in plan and "LeftAnti, BuildRight" in plan and "FullOuter" not in plan
    assert out.count() == 202 and len(_reads(plan, tmp_path / "t")) == 2
    t2 = target.select("id", "name", "file_name")
    up = merge.upsert_all(t2, batch.select("id", "name", "file_name"), ["id"])
    plan = _final(up)
    assert "LeftOuter, BuildRight" in plan and "LeftSemi, BuildRight" in plan and "SortMergeJoin" not in plan
    assert sorted(_reads(plan, tmp_path / "t")) == ["id:bigint", "id:bigint,name:string,file_name:string"]
    assert up.count() == 201
    c = diff.classify_changes(target.filter("status = 'Active'"), batch, ["id"], ["name", "email"])
    plan = _final(c)
    assert sorted(_reads(plan, tmp_path / "t")) == ["id:bigint,name:string,email:string,status:string", "id:bigint,status:string"]
    assert c.count() == 201


def test_large_batch_upsert_shuffles_the_target_once(spark, tmp_path):
    target, batch = _emp_files(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        up = merge.upsert_all(target.select("id", "name"), batch.select("id", "name"), ["id"])
        plan = _final(up)
        assert sorted(_reads(plan, tmp_path / "t")) == ["id:bigint", "id:bigint,name:string"]
        # the keys of the table are shuffled besides, never its rows again
        assert len(re.findall(r"Exchange hashpartitioning\(id#\d+L, \d+\)[^\n]*\n[^\n]*Project \[id#\d+L, struct", plan)) == 1, plan
        out = history.two_version_merge(target, batch, run_ts="2024-02-01 00:00:00")
        assert len(_reads(_final(out), tmp_path / "t")) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_type1_is_one_exchange_with_partial_aggregate(spark):
    df = spark.range(100).selectExpr("id % 7 as k", "id as seq", "id * 2 as v")
    out = cdc.scd1(df, ["k"], "seq", tiebreak=[], columns=["v"])
    plan = _plan(out)
    assert _exchanges(out) == 1 and "partial_max_by" in plan


def test_type2_is_one_scan_and_one_exchange(spark):
    """The plan that ran: one window pass over one exchange by the struct key."""
    out = QUERIES["cdc_scd2_tracked"](spark, SMALL)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString()
    final = final.split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange hashpartitioning", final)) == 1 and final.count("FileScan parquet") == 1, final
    assert re.search(r"Exchange hashpartitioning\(__k#\d+, \d+\)", final)


def test_stacked_filters_become_one_pushed_predicate(spark, tmp_path):
    p = str(tmp_path / "emp")
    spark.createDataFrame([(1, "F", 2001), (2, "M", 2021)], "id long, gender string, dob int").write.parquet(p)
    out = stacked_filters(spark.read.parquet(p), ["gender = 'F' AND dob > 1990", "gender = 'F' AND dob >= 2000"])
    plan = _plan(out)
    assert "PushedFilters: [IsNotNull(gender), IsNotNull(dob), EqualTo(gender,F)" in plan
    assert plan.count("Filter ") == 1


def test_projection_is_pruned_to_the_scan(spark):
    out = QUERIES["rows_for_day"](spark, SMALL)
    plan = _plan(out)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_no_python_evaluation_in_any_batch_query(spark):
    for name, fn in QUERIES.items():
        if name.startswith("stream_") or name in {"csv_roundtrip_scan", "file_provenance_counts"}:
            continue
        plan = _plan(fn(spark, SMALL))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_hot_keys_are_spread_over_ranges_and_others_take_the_single_window(spark):
    df = spark.range(3000).selectExpr("id % 3 as k", "id as seq", "cast(id % 2 as string) as v")
    split = cdc.scd2(df, ["k"], "seq", track_columns=["v"], hot_key_rows=100)
    plan = _plan(split)
    # cold keys: the anti join against the hot keys; hot keys: sorted ranges
    assert "LeftAnti" in plan and "scd2-ranges" in plan and "Union" in plan
    whole = cdc.scd2(df, ["k"], "seq", track_columns=["v"])  # no key reaches the default threshold
    plain = _plan(whole)
    assert "Join" not in plain and "Union" not in plain
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, split.collect()), key=key) == sorted(map(tuple, whole.collect()), key=key)


def test_expect_or_fail_guard_survives_projection(spark):
    from tidemark.operators.quality import expect_or_fail

    df = spark.range(3).select(F.col("id"), F.lit("x").alias("w"))
    assert "raise_error" in _plan(expect_or_fail(df, {"id small": "id < 10"}).select("w"))


def test_chunked_path_partitions_by_key_and_chunk(spark):
    """The chunked path's per-chunk runs are partitioned by (key, chunk) (the
    window runs in the staging job with the same partitioning); only the
    small per-chunk summary is ordered per key.  Same result as one window."""
    import datetime as _dt

    base = _dt.datetime(2024, 1, 1)
    rows = [(0 if i % 3 == 0 else i % 50, base + _dt.timedelta(minutes=7 * i), i, "abc"[i % 3]) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, tb long, v string")
    out = cdc.scd2(df, ["k"], "ts", track_columns=["v"], tiebreak=["tb"], columns=["ts", "tb", "v"],
                   chunk=F.date_trunc("hour", "ts"))
    plan = _plan(out)
    row_level = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("__c" in e and "__k" in e for e in row_level)  # the window exchange: (key, chunk)
    assert out.count() == cdc.scd2_windowed(df, ["k"], "ts", tiebreak=["tb"], track_columns=["v"],
                                            columns=["ts", "tb", "v"]).count()


def test_one_load_stamp_and_odd_sequences_are_split_by_the_data(spark):
    """A hot key whose sequence is one constant, holds NaN and nulls, or spans one day still gets many chunks."""
    rows = [(0, "2025-06-01 10:00:00", float("nan") if i % 97 == 0 else None if i % 89 == 0 else float(i % 1000), i, "abc"[i % 3 if i % 7 else 0])
            for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, stamp string, x double, tb long, v string")
    for seq in ("stamp", "x"):
        split = cdc.scd2(df, ["k"], seq, track_columns=["v"], tiebreak=["tb"], columns=[seq, "tb", "v"], hot_key_rows=400)
        whole = cdc.scd2(df, ["k"], seq, track_columns=["v"], tiebreak=["tb"], columns=[seq, "tb", "v"], split_hot_keys=False)
        assert "scd2-ranges" in _plan(split)
        assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_a_hot_key_is_spread_over_tasks_and_equal_sequences_still_fail(spark):
    """Runs that cross many ranges, versions that open at a range's first row, and a tie on a range's border."""
    import pytest

    rows = [(0, i, "x" if 300 < i < 2600 else "ab"[(i // 7) % 2]) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, seq long, v string")
    args = dict(track_columns=["v"], columns=["seq", "v"], start_order_col="o")
    split = cdc.scd2(df, ["k"], "seq", hot_key_rows=100, **args)
    whole = cdc.scd2(df, ["k"], "seq", split_hot_keys=False, **args)
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    for at in (0, 374, 375, 376, 1500, 2998):  # ranges hold 375 rows
        again = df.unionByName(spark.createDataFrame([(0, at, "new")], df.schema))
        with pytest.raises(Exception, match="equal sequence"):
            cdc.scd2(again, ["k"], "seq", hot_key_rows=100, track_columns=["v"], columns=["seq", "v"]).collect()
