"""Places and running totals over range partitions, against plain Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.operators.order import running


def test_running_totals_equal_a_plain_loop(spark):
    r = random.Random(3)
    data = [(r.randrange(40) if r.random() > 0.1 else None, i, r.randrange(-50, 50) if r.random() > 0.1 else None)
            for i in range(900)]
    df = spark.createDataFrame(data, "k int, i int, v long").repartition(5)
    got = running(df, [F.col("k").asc_nulls_last(), "i"], sums={"s": "v"}, xors={"x": "v"}).collect()
    want, s, x = [], 0, 0
    for at, (k, i, v) in enumerate(sorted(data, key=lambda t: (t[0] is None, t[0] or 0, t[1]))):
        want.append((k, i, v, at, s, x))
        s, x = s + (v or 0), x ^ (v or 0)
    assert sorted(map(tuple, got), key=lambda t: t[3]) == want


def test_places_of_equal_rows_are_distinct_and_an_empty_table_is_empty(spark):
    df = spark.createDataFrame([(1,)] * 500, "k int")
    assert sorted(r.at for r in running(df, ["k"]).collect()) == list(range(500))
    assert running(df.limit(0), ["k"], sums={"s": "k"}).collect() == []


def test_no_task_holds_one_hot_key(spark):
    """A key with all the rows is split by the rest of the order."""
    df = spark.range(20_000).select(F.lit(1).alias("k"), "id")
    out = running(df, ["k", "id"], sums={"s": "id"}, partitions=8)
    assert out.selectExpr("max(abs(at - id))").first()[0] == 0
    assert out.selectExpr("max(abs(s - id * (id - 1) div 2))").first()[0] == 0
    plan = out._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
