"""CSV text written by hand: nothing is lost or swapped without an error."""

from __future__ import annotations

import datetime as dt

import pytest

from tidemark.sources import files
from tidemark.streaming.ingest import file_stream, run_available


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_both_timestamp_layouts_are_read(spark, tmp_path):
    p = put(tmp_path / "ts", "a.csv", "id,at\n1,2024-01-01 10:00:00\n2,2024-01-01T10:00:00\n3,2024-01-01 10:00:00.123456\n")
    got = [r.at for r in files.read_csv(spark, p, "id int, at timestamp_ntz").orderBy("id").collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 0, 0, 123456)]


def test_reordered_header_is_an_error_not_swapped_columns(spark, tmp_path):
    p = put(tmp_path / "order", "a.csv", "name,id\n7,8\n")
    for read in (lambda: files.read_csv(spark, p, "id int, name string"),
                 lambda: files.read_csv_rescued(spark, p, {"id": "int", "name": "string"})):
        with pytest.raises(Exception, match="(?i)header"):
            read().collect()


def test_bad_values_and_extra_fields_fail_unless_asked_for(spark, tmp_path):
    p = put(tmp_path / "bad", "a.csv", "id,v\n1,2\nx,3\n4,5,6\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, p, "id int, v int").collect()
    got = {r.id: r._rescued_data for r in files.read_csv_rescued(spark, p, {"id": "int", "v": "int"}).collect()}
    assert got[1] is None and '"id":"x"' in got[None] and "4,5,6" in got[4]


def test_line_breaks_are_refused_or_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c")], "id int, t string")
    with pytest.raises(Exception, match="line break in column t"):
        files.write_csv(df, str(tmp_path / "no"))
    files.write_csv(df, str(tmp_path / "yes"), multi_line=True)
    got = files.read_csv(spark, str(tmp_path / "yes"), "id int, t string", multi_line=True).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a\nb"), (2, "c")]


def test_stream_reads_the_same_way(spark, tmp_path):
    p = put(tmp_path / "st", "a.csv", "id,at\n1,2024-01-01T10:00:00\n")
    out = str(tmp_path / "out")
    run_available(file_stream(spark, p, "id int, at timestamp_ntz"), str(tmp_path / "c"), path=out)
    assert [r["at"] for r in spark.read.parquet(out).collect()] == [dt.datetime(2024, 1, 1, 10)]
    put(tmp_path / "st", "b.csv", "at,id\n2024-01-01T10:00:00,1\n")
    with pytest.raises(Exception):
        run_available(file_stream(spark, p, "id int, at timestamp_ntz"), str(tmp_path / "c"), path=out)


def test_inactive_only_key_gets_the_incoming_row(spark):
    from tidemark.operators.history import two_version_merge

    cols = ("id long, name string, dob int, gender string, country string, email string, eskey int, status string, "
            "start_date timestamp_ntz, end_date timestamp_ntz, file_name string, created_date timestamp_ntz")
    old = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([(1, "n", 1, "F", "C", "e", 1, "InActive", old, old, "f", old)], cols)
    batch = spark.createDataFrame([(1, "new", 2, "F", "C", "e", "g")],
                                  "id long, name string, dob int, gender string, country string, email string, file_name string")
    fixed = {(r.status, r.name) for r in two_version_merge(target, batch, run_ts="2025-01-01 00:00:00").collect()}
    assert fixed == {("InActive", "n"), ("Active", "new")}
    same = {(r.status, r.name) for r in two_version_merge(target, batch, run_ts="2025-01-01 00:00:00", compat=True).collect()}
    assert same == {("InActive", "n")}
