"""Sinks: named single-file export with a row cap, JDBC append, versioned publish, aligned append."""

from __future__ import annotations

import os
import uuid

import pytest

from tidemark.operators.publish import (
    append_aligned, export_single_csv, publish_version, read_current, write_jdbc,
)


def test_single_file_export_named_and_capped(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id * 2 as twice")
    path = export_single_csv(df, str(tmp_path / "exp"), "extract_20240201.csv")
    assert os.path.basename(path) == "extract_20240201.csv"
    assert [f for f in os.listdir(tmp_path / "exp") if not f.startswith(".")] == ["extract_20240201.csv"]
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 10
    with pytest.raises(ValueError, match="more than 5 rows"):
        export_single_csv(df, str(tmp_path / "exp2"), "x.csv", row_cap=5)


def test_jdbc_append_to_embedded_derby(spark):
    url = f"jdbc:derby:memory:tm{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    write_jdbc(df, url, "EMP", props)
    write_jdbc(df, url, "EMP", props)
    assert spark.read.jdbc(url, "EMP", properties=props).count() == 4


def test_publish_version_moves_pointer_last(spark, tmp_path):
    root = str(tmp_path / "tbl")
    assert read_current(spark, root) is None
    publish_version(spark.range(3), root, 1)
    publish_version(spark.range(5), root, 2)
    assert read_current(spark, root).count() == 5


def test_append_aligned_by_name_with_casts(spark):
    target = spark.createDataFrame([(1, 1990, "x")], "id long, dob int, name string")
    incoming = spark.createDataFrame([("x2", "2", "2001", "junk")], "name string, ID string, dob string, extra string")
    out = sorted(tuple(r) for r in append_aligned(target, incoming).collect())
    assert out == [(1, 1990, "x"), (2, 2001, "x2")]
    bad = spark.createDataFrame([("y", "notanumber", "1")], "name string, id string, dob string")
    with pytest.raises(Exception):
        append_aligned(target, bad).collect()
    assert append_aligned(target, bad, strict=False).filter("id is null").count() == 1


def test_cluster_conf_and_gate(spark):
    from tidemark.operators.quality import has_rows
    from tidemark.session import cluster_conf

    conf = cluster_conf(100 << 40, 8000, checkpoint_dir="hdfs:///shared/ckpt")
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert conf["spark.checkpoint.dir"] == "hdfs:///shared/ckpt"
    assert int(cluster_conf(1 << 20, 64)["spark.sql.shuffle.partitions"]) == 192
    assert has_rows(spark.range(3)) and not has_rows(spark.range(0))


def test_scratch_listing_by_age(spark, tmp_path):
    import os
    import time

    from tidemark.session import scratch_to_clear

    base = tmp_path / "tidemark-scratch"
    old, new = base / "old-run", base / "new-run"
    old.mkdir(parents=True)
    new.mkdir()
    past = time.time() - 3 * 3600
    os.utime(old, (past, past))
    got = scratch_to_clear(spark, older_than_hours=1, root=str(tmp_path))
    assert [g.rstrip("/").split("/")[-1] for g in got] == ["old-run"]
    assert scratch_to_clear(spark, older_than_hours=1, root=str(tmp_path / "nowhere")) == []
