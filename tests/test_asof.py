"""As-of reads for a column of instants against a plain search."""

from __future__ import annotations

import random

import pytest

from tidemark.operators.asof import as_of_each


def plain(versions, asks):
    out = []
    for n, k, t in asks:
        hit = None
        for vk, s, e, v in sorted(versions, key=lambda x: (x[1] is not None, x[1] or 0, x[2] is None, x[2] or 0)):
            if k is not None and vk == k and t is not None and (s is None or s <= t):
                hit = (s, e, v)
        if hit is not None and hit[1] is not None and not t < hit[1]:
            hit = None
        out.append((n, k, t, *(hit or (None, None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_as_of_each_equals_a_search(spark, partitions):
    r = random.Random(partitions)
    versions = []
    for k in range(6):
        cuts = sorted(r.sample(range(1, 400), 120 if k == 0 else r.randint(1, 6)))  # key 0 has most versions
        for a, b in zip(cuts, [*cuts[1:], None]):
            if r.random() < 0.9:  # gaps
                versions.append((k, a, b if r.random() < 0.9 or b is None else b - 0, f"v{a}"))
    versions += [(3, 50, 50, "empty interval"), (None, 1, None, "no key")]
    asks = [(i, r.choice([0, 0, 0, 1, 2, 3, 4, 5, 9, None]), r.choice([None, *range(0, 420)])) for i in range(600)]
    h = spark.createDataFrame(versions, "k int, __START_AT int, __END_AT int, v string")
    q = spark.createDataFrame(asks, "n int, k int, t int").repartition(3)
    got = as_of_each(h, q, ["k"], "t", partitions=partitions)
    assert got.columns == ["n", "k", "t", "__START_AT", "__END_AT", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(versions, asks)


def test_versions_without_ends_and_empty_sides(spark):
    h = spark.createDataFrame([(1, 10, "a"), (1, 20, "b")], "k int, s int, v string")
    q = spark.createDataFrame([(1, 5), (1, 10), (1, 25), (2, 25)], "k int, t int")
    got = as_of_each(h, q, ["k"], "t", start_col="s", end_col=None, columns=["v"])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 10, "a"), (1, 25, "b"), (1, 5, None), (2, 25, None)]
    assert {r.v for r in as_of_each(h.limit(0), q, ["k"], "t", start_col="s", end_col=None, columns=["v"]).collect()} == {None}
    assert as_of_each(h, q.limit(0), ["k"], "t", start_col="s", end_col=None, columns=["v"]).collect() == []
    with pytest.raises(ValueError, match="both sides"):
        as_of_each(h, q.withColumnRenamed("t", "v"), ["k"], "v", start_col="s", end_col=None)
