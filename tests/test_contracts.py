"""Contract tests on small inline tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.compare import differs, fingerprint
from tidemark.functions.text import mask_email
from tidemark.functions.time import on_day, parse_mixed
from tidemark.operators import diff, history, merge, quality
from tidemark.operators.filters import param_filter
from tidemark.sources import files

T0 = dt.datetime(2024, 1, 1)
RUN = "2024-02-01 00:00:00"
RUN_DT = dt.datetime(2024, 2, 1)
FAR = dt.datetime(9999, 12, 31)

TARGET_SCHEMA = ("id long, name string, dob int, gender string, country string, email string, eskey int, "
                 "status string, start_date timestamp_ntz, end_date timestamp_ntz, file_name string, "
                 "created_date timestamp_ntz")
BATCH_SCHEMA = "id long, name string, dob int, gender string, country string, email string, file_name string"


def _active(i, name, start=T0):
    return (i, name, 1990, "F", "X", f"{name}@a.org", 0, "Active", start, FAR, "f1.csv", T0)


def _inactive(i, name):
    return (i, name, 1990, "F", "X", f"{name}@a.org", 1, "InActive", dt.datetime(2023, 1, 1), T0, "f0.csv", T0)


def _batch(i, name, file_name="f1.csv"):
    return (i, name, 1990, "F", "X", f"{name}@a.org", file_name)


# ------------------------------------------------------------------ P-12 / C-01
def test_null_safe_diff_sees_swapped_nulls(spark):
    df = spark.createDataFrame([("a", None, None, "a")], "l1 string, l2 string, r1 string, r2 string")
    out = df.select(differs(["l1", "l2"], ["r1", "r2"]).alias("d"),
                    (F.xxhash64("l1", "l2") == F.xxhash64("r1", "r2")).alias("raw_hash_equal"),
                    (fingerprint(["l1", "l2"]) == fingerprint(["r1", "r2"])).alias("fp_equal")).first()
    assert out.d is True
    assert out.raw_hash_equal is True  # the trap the reference falls into
    assert out.fp_equal is False


def test_classify_all_classes_and_null_key(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, v string")
    b = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d"), (None, "x")], "id long, v string")
    got = rows(diff.classify_changes(t, b, ["id"], ["v"]))
    assert got == [(None, "null_key"), (1, "unchanged"), (2, "update"), (3, "unchanged"), (4, "new")]
    t2 = t.unionByName(spark.createDataFrame([(9, "z")], "id long, v string"))
    assert (9, "missing") in rows(diff.classify_changes(t2, b, ["id"], ["v"]))


def test_classify_new_only_plan_has_no_full_outer(spark):
    t = spark.createDataFrame([(1, "a")], "id long, v string")
    b = spark.createDataFrame([(2, "b")], "id long, v string")
    plan = diff.classify_changes(t, b, ["id"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan


# ------------------------------------------------------------------ M-05
def test_two_version_contract_compat(spark):
    target = spark.createDataFrame(
        [_active(1, "a"), _active(2, "b"), _inactive(2, "b0"), _inactive(3, "c0"), _active(4, "d")], TARGET_SCHEMA)
    batch = spark.createDataFrame(
        [_batch(1, "a2"), _batch(2, "b"), _batch(3, "c9"), _batch(4, "d"), _batch(5, "e")], BATCH_SCHEMA)
    out = {(r.id, r.status): r for r in
           history.two_version_merge(target, batch, run_ts=RUN, compat=True).collect()}
    # 1. new id
    assert out[(5, "Active")].start_date == RUN_DT and out[(5, "Active")].end_date == FAR
    # 2. changed id keeps the old dates on the new version
    assert out[(1, "Active")].name == "a2" and out[(1, "Active")].start_date == T0
    assert out[(1, "Active")].created_date == RUN_DT
    # 3. previous version: values of the old active row
    assert out[(1, "InActive")].name == "a" and out[(1, "InActive")].end_date == RUN_DT
    # 3b. an id with an InActive row is always "changed"; that row keeps its dates
    assert out[(2, "InActive")].name == "b" and out[(2, "InActive")].start_date == dt.datetime(2023, 1, 1)
    # 4. only an InActive row: unchanged
    assert out[(3, "InActive")].name == "c0" and (3, "Active") not in out
    # 5. unchanged id copied as it is
    assert out[(4, "Active")].created_date == T0
    assert len(out) == 7


def test_two_version_default_moves_dates_and_skips_unchanged(spark):
    target = spark.createDataFrame([_active(1, "a"), _active(4, "d")], TARGET_SCHEMA)
    batch = spark.createDataFrame([_batch(1, "a2"), _batch(4, "d", "other.csv")], BATCH_SCHEMA)
    out = {(r.id, r.status): r for r in history.two_version_merge(target, batch, run_ts=RUN).collect()}
    assert out[(1, "Active")].start_date == RUN_DT and out[(1, "InActive")].start_date == T0
    assert out[(1, "InActive")].end_date == RUN_DT
    assert (4, "InActive") not in out  # a new file name alone is no change by default


def test_two_version_rejects_conflicting_batch_rows(spark):
    target = spark.createDataFrame([_active(1, "a")], TARGET_SCHEMA)
    batch = spark.createDataFrame([_batch(1, "x"), _batch(1, "y")], BATCH_SCHEMA)
    with pytest.raises(Exception, match="several different rows"):
        history.two_version_merge(target, batch, run_ts=RUN).collect()
    same = spark.createDataFrame([_batch(1, "x"), _batch(1, "x")], BATCH_SCHEMA)
    assert history.two_version_merge(target, same, run_ts=RUN).count() == 2


def test_two_version_empty_batch_and_empty_target(spark):
    target = spark.createDataFrame([_active(1, "a")], TARGET_SCHEMA)
    empty_b = spark.createDataFrame([], BATCH_SCHEMA)
    assert rows(history.two_version_merge(target, empty_b, run_ts=RUN)) == rows(target)
    empty_t = spark.createDataFrame([], TARGET_SCHEMA)
    out = history.two_version_merge(empty_t, spark.createDataFrame([_batch(7, "n")], BATCH_SCHEMA), run_ts=RUN)
    assert [(r.id, r.status) for r in out.collect()] == [(7, "Active")]


def test_two_version_observation_counts(spark):
    target = spark.createDataFrame([_active(1, "a"), _active(4, "d")], TARGET_SCHEMA)
    batch = spark.createDataFrame([_batch(1, "a2"), _batch(9, "n")], BATCH_SCHEMA)
    obs = Observation("m")
    history.two_version_merge(target, batch, run_ts=RUN, observation=obs).collect()
    assert obs.get == {"num_inserted": 1, "num_updated": 2, "num_copied": 1}


# ------------------------------------------------------------------ M-01 .. M-04
def test_upsert_policies(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, v string, seq int")
    s = spark.createDataFrame([(1, "x", 2), (1, "y", 3), (3, "z", 1)], "id long, v string, seq int")
    with pytest.raises(Exception, match="several different rows"):
        merge.upsert_all(t, s, ["id"]).collect()
    got = rows(merge.upsert_all(t, s, ["id"], on_duplicates="latest", sequence_by=["seq"]))
    assert got == [(1, "y", 3), (2, "b", 1), (3, "z", 1)]


def test_upsert_rejects_null_keys(spark):
    t = spark.createDataFrame([(1, "a")], "id long, v string")
    s = spark.createDataFrame([(None, "x")], "id long, v string")
    with pytest.raises(Exception, match="null key"):
        merge.upsert_all(t, s, ["id"]).collect()


def test_upsert_mapped_delete_and_metrics(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    s = spark.createDataFrame([(1, "A"), (2, "DEL"), (4, "d")], "id long, v string")
    obs = Observation("u")
    out = merge.upsert_mapped(t, s, ["id"], update_set={"v": "s.v"}, insert_values={"id": "s.id", "v": "s.v"},
                              delete_condition="s.v = 'DEL'", observation=obs)
    assert rows(out) == [(1, "A"), (3, "c"), (4, "d")]
    assert obs.get == {"num_inserted": 1, "num_updated": 1, "num_deleted": 1, "num_copied": 1}


def test_merge_delete_only_matching_predicate(spark):
    t = spark.createDataFrame([(1, "Active"), (1, "InActive"), (2, "InActive")], "id long, status string")
    s = spark.createDataFrame([(1,)], "id long")
    assert rows(merge.merge_delete(t, s, ["id"], "status = 'InActive'")) == [(1, "Active"), (2, "InActive")]


# ------------------------------------------------------------------ M-08
def test_versioned_history_requires_single_current_row(spark):
    schema = "id long, name string, mobile string, version int, datetime timestamp_ntz, status string"
    t = spark.createDataFrame([(1, "a", "1", 0, T0, "Active"), (1, "a0", "0", 1, T0, "InActive")], schema)
    b = spark.createDataFrame([(1, "b", "2")], "id long, name string, mobile string")
    with pytest.raises(Exception, match="exactly one version-0"):
        history.versioned_history_merge(t, b, run_ts=RUN).collect()


# ------------------------------------------------------------------ P-11, P-09, P-15, P-06
# Fixed cases of the reference's Java pattern.
MASK_CASES = [
    ("alice@x.org", "alxxxxxx@x.org"),
    ("ab@x.org", "abxxx@x.org"),
    ("a@x.org", "a@x.org"),
    ("no-at-sign", "no-at-sign"),
    (None, None),
    ("a.b@c@d.org", "a.xxxxxx@d.org"),
]


def test_mask_email_cases(spark):
    df = spark.createDataFrame([(a,) for a, _ in MASK_CASES], "e string")
    got = [r[0] for r in df.select(mask_email(F.col("e"))).collect()]
    assert got == [b for _, b in MASK_CASES]


def test_on_day_is_pushed_to_parquet(spark, tmp_path):
    p = str(tmp_path / "ev")
    spark.createDataFrame([(dt.datetime(2024, 1, 3, 5), 1), (dt.datetime(2024, 1, 4), 2)],
                          "ts timestamp_ntz, v int").write.parquet(p)
    df = spark.read.parquet(p).filter(on_day(F.col("ts"), "2024-01-03"))
    assert [r.v for r in df.collect()] == [1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_parse_mixed_layouts(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05",), ("2024-01-02 03:04:05",), ("junk",)], "t string")
    got = [r[0] for r in df.select(parse_mixed(F.col("t"))).collect()]
    assert got[0] == got[1] is not None and got[2] is None


def test_param_filter_casts_parameter(spark):
    df = spark.createDataFrame([(1, 1999), (2, 2001)], "id long, dob int")
    assert [r.id for r in param_filter(df, "dob", ">", "2000").collect()] == [2]
    with pytest.raises(ValueError):
        param_filter(df, "dob", "; drop", "1")
    with pytest.raises(Exception):
        param_filter(df, "dob", ">", "abc").collect()


# ------------------------------------------------------------------ Q-*
def test_expect_or_fail_raises_with_rule_name(spark):
    df = spark.createDataFrame([(1,), (-1,)], "v int")
    with pytest.raises(Exception, match="v positive"):
        quality.expect_or_fail(df, {"v positive": "v > 0"}).collect()


def test_expect_or_fail_is_not_pruned(spark):
    df = spark.createDataFrame([(1, "a"), (-1, "b")], "v int, w string")
    with pytest.raises(Exception, match="v positive"):
        quality.expect_or_fail(df, {"v positive": "v > 0"}).select("w").collect()


def test_expect_warn_and_drop_count_with_null_as_failure(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    obs = Observation("q")
    kept = quality.expect_or_drop(df, {"v positive": "v > 0"}, observation=obs)
    assert kept.count() == 1
    assert obs.get == {"rows": 3, "failed:v positive": 2}


def test_quarantine_names_failed_rules(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "v int, w string")
    good, bad = quality.quarantine(df, {"v set": "v is not null", "w set": "w is not null"})
    assert good.count() == 1
    assert bad.first().failed_rules == ["v set", "w set"]


def test_not_null_rules_from_schema(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.IntegerType(), True)])
    assert list(quality.not_null_rules(schema)) == ["a is not null"]


def test_file_name_rules_strict_and_compat(spark):
    names = ["BranchData_20250601.csv", "BranchData_20250601Xcsv_x.csv", "Other_20250601.csv", "PayrollData_20250602.csv",
             "EmployeeData_20250601.txt"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select(quality.valid_origin_name(F.col("n"), "20250601").alias("s"),
                    quality.valid_origin_name(F.col("n"), "20250601", compat=True).alias("c")).collect()
    assert [(r.s, r.c) for r in got] == [(True, True), (False, True), (False, False), (False, False), (False, False)]
    routed = quality.route_files(df, "n", "20250601")
    assert [r.route for r in routed.collect()] == ["accepted", "rejected", "rejected", "rejected", "ignored"]


# ------------------------------------------------------------------ S-04
def test_rescue_keeps_bad_values(spark):
    df = spark.createDataFrame([("1", "2.5", "x"), ("zz", "3", None)], "a string, b string, extra string")
    out = files.rescue(df, {"a": "int", "b": "double"}).collect()
    assert out[0].a == 1 and out[0]._rescued_data == '{"extra":"x"}'
    assert out[1].a is None and out[1]._rescued_data == '{"a":"zz"}'


def test_schema_persistence_roundtrip(spark, tmp_path):
    p = str(tmp_path / "in")
    spark.createDataFrame([(1, "a")], "x int, y string").write.option("header", True).csv(p)
    loc = str(tmp_path / "schema")
    s1 = files.stream_schema(spark, p, loc)
    assert files.load_schema(spark, loc) == s1
    assert [f.name for f in s1.fields] == ["x", "y"]


def test_no_python_udf_in_registered_batch_plans(spark):
    from tests.conftest import SMALL
    from tidemark.plans.all import QUERIES

    for name in ["two_version_merge", "classify_changes", "cdc_scd2_tracked", "mask_email", "url_basename",
                 "rescue_malformed", "profile_table", "merge_audit"]:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_errors_are_spark_errors(spark):
    df = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(PySparkException):
        quality.expect_or_fail(df, {"never": "v < 0"}).collect()


# ------------------------------------------------------------------ O-07 end to end
def test_merge_metrics_flow_into_the_audit_table(spark):
    import datetime as _dt

    from tidemark.operators import audit

    t = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    s = spark.createDataFrame([(1, "A"), (3, "c")], "id long, v string")
    obs = Observation("merge1")
    merge.upsert_all(t, s, ["id"], observation=obs).write.format("noop").mode("overwrite").save()
    log1 = audit.commit_log(spark, "1", "MERGE", obs, ts=_dt.datetime(2024, 1, 1), user="u")
    log2 = audit.commit_log(spark, "2", "MERGE", {"num_inserted": 5, "num_updated": 0, "num_deleted": 1},
                            ts=_dt.datetime(2024, 1, 2), user="u")
    log3 = audit.commit_log(spark, "3", "OPTIMIZE", {"num_inserted": 9}, ts=_dt.datetime(2024, 1, 3), user="u")
    commits = log1.unionByName(log2).unionByName(log3)
    piv = {r.version: r for r in audit.metrics_pivot(commits).collect()}
    assert set(piv) == {"1", "2"}  # OPTIMIZE is not audited
    assert (piv["1"].numTargetRowsInserted, piv["1"].numTargetRowsUpdated, piv["1"].numTargetRowsDeleted) == (1, 1, 0)
    empty = spark.createDataFrame([], "operation string, update_time timestamp, user_name string, "
                                      "notebook_name string, numTargetRowsInserted bigint, "
                                      "numTargetRowsUpdated bigint, numTargetRowsDeleted bigint")
    out = audit.merge_audit(empty, audit.metrics_pivot(commits), notebook_name="nb").collect()
    assert len(out) == 1 and out[0].numTargetRowsInserted == 5 and out[0].notebook_name == "nb"


def test_classes_partition_the_union_of_keys(spark):
    import random

    rnd = random.Random(3)
    t = spark.createDataFrame([(i, rnd.choice("ab")) for i in range(0, 300, 2)], "id long, v string")
    b = spark.createDataFrame([(i, rnd.choice("ab")) for i in range(0, 300, 3)], "id long, v string")
    got = diff.classify_changes(t, b, ["id"], ["v"]).collect()
    ids = [r.id for r in got]
    assert len(ids) == len(set(ids))
    assert set(ids) == set(range(0, 300, 2)) | set(range(0, 300, 3))


def test_write_quarantined_single_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "v int, w string")
    quality.write_quarantined(df, {"v set": "v is not null"}, str(tmp_path / "q"))
    back = spark.read.parquet(str(tmp_path / "q"))
    assert back.filter("side = 'bad'").count() == 1 and back.filter("side = 'good'").count() == 2
    plan = back.filter("side = 'bad'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(side" in plan


def test_hot_key_third_of_rows(spark):
    """One key holds a third of the changes: type 1, latest-wins upsert and
    conflict reports stay exact (partial aggregation absorbs the hot key)."""
    from tidemark.operators import cdc

    n = 3000
    rows = [((0 if i % 3 == 0 else i), i, f"v{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "k long, seq long, v string").repartition(8)
    t1 = {r.k: r.v for r in cdc.scd1(df, ["k"], "seq", columns=["v"]).collect()}
    assert t1[0] == f"v{n - 3}" and len(t1) == 1 + (n - n // 3)
    target = spark.createDataFrame([(0, 0, "old")], "k long, seq long, v string")
    up = {r.k: r.v for r in merge.upsert_all(target, df, ["k"], on_duplicates="latest", sequence_by=["seq"]).collect()}
    assert up == t1
    conflicts = {r.k: r.n_rows for r in merge.merge_conflicts(df, ["k"]).collect()}
    assert conflicts == {0: n // 3}


def test_rescue_matches_names_case_insensitively(spark):
    df = spark.createDataFrame([("7", "x")], "ID string, Name string")
    out = files.rescue(df, {"id": "int", "name": "string"}).first()
    assert out.id == 7 and out.name == "x" and out._rescued_data is None


def test_target_rows_with_null_keys_are_kept(spark):
    t = spark.createDataFrame([(None, "orphan"), (1, "a")], "id long, v string")
    s = spark.createDataFrame([(1, "A"), (2, "b")], "id long, v string")
    got = rows(merge.upsert_all(t, s, ["id"]))
    assert got == [(None, "orphan"), (1, "A"), (2, "b")]
    c = rows(diff.classify_changes(t, s, ["id"], ["v"]))
    assert (None, "missing") in c


def test_read_csv_rescued_keeps_bad_values_and_broken_lines(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("id,dob\n1,1990\n2,zz\n3,1991,extra\n4\n")
    got = {r.id: (r.dob, r._rescued_data) for r in files.read_csv_rescued(spark, str(p), {"id": "int", "dob": "int"})
           .collect()}
    assert got[1] == (1990, None)
    assert got[2] == (None, '{"dob":"zz"}')
    assert got[3][0] == 1991 and got[3][1] is not None and "_corrupt_record" in got[3][1]
    assert got[4] == (None, '{"_corrupt_record":"4"}')  # too few fields: kept as well


def test_wide_null_safe_diff_uses_one_struct_comparison(spark):
    n = 40
    left = [f"l{i}" for i in range(n)]
    right = [f"r{i}" for i in range(n)]
    same = [None if i % 3 == 0 else i for i in range(n)]
    other = list(same)
    other[5] = None  # a value replaced by null must count as a change
    df = spark.createDataFrame([tuple(same + same), tuple(same + other)],
                               ", ".join(f"{c} int" for c in left + right))
    assert [r[0] for r in df.select(differs(left, right)).collect()] == [False, True]


def test_two_version_default_replay_is_idempotent(spark):
    target = spark.createDataFrame([_active(1, "a"), _active(2, "b"), _inactive(2, "b0")], TARGET_SCHEMA)
    batch = spark.createDataFrame([_batch(1, "a2"), _batch(3, "c")], BATCH_SCHEMA)
    once = history.two_version_merge(target, batch, run_ts=RUN)
    once_rows = rows(once)
    twice = history.two_version_merge(spark.createDataFrame(once_rows, TARGET_SCHEMA), batch,
                                      run_ts="2024-03-01 00:00:00")
    assert rows(twice) == once_rows
