"""Hard negatives against all scores, and Strassen's product against the plain one."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id int, asks boolean, place long"


def plain(rows) -> list[tuple]:
    fine = [(i, l, v) for i, v, l in rows if i is not None and l is not None and v
            and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, _, v in fine]
    if not fine:
        return []
    n = min(sorted(set(lengths)), key=lambda x: -lengths.count(x))
    fine = {(i, l, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, l, v in fine if len(v) == n}
    out = []
    for i, l, v in fine:
        if i % 100:
            continue
        scored = sorted({(-sum(x * y for x, y in zip(v, w)), j, m == l) for j, m, w in fine if j != i})
        for p, j, _ in [x for x in scored if x[2]][:5]:
            window = [x for x in scored if not x[2] and -80 * p <= -100 * x[0] <= -100 * p][:5]
            out += [(i, j, k + 1, m, -p, -s) for k, (s, m, _) in enumerate(window)]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(i, v, l, "w", 1, True, 5) for i, v, l in rows], SCHEMA)


def mined(df) -> list[tuple]:
    return sorted(tuple(r) for r in hard.mine(df, F.col("vec_id") % 100 == 0).collect())


@pytest.mark.parametrize("m, k, n", [(1, 1, 1), (3, 64, 5), (33, 17, 40), (64, 64, 64), (100, 65, 257), (0, 8, 4)])
def test_strassen_is_exact(m, k, n):
    r = np.random.RandomState(m + k + n)
    a, b = r.randint(-2 ** 28, 2 ** 28, (m, k)), r.randint(-2 ** 28, 2 ** 28, (k, n))
    assert (hard.strassen(a, b) == a @ b).all()


def test_heaps_merge_to_the_best_of_all():
    r = np.random.RandomState(4)
    group, score, own = r.randint(0, 6, 400), r.randint(0, 20, 400), r.randint(0, 50, 400)
    whole = hard.best(group, score, own, 7)
    parts = [hard.best(group[s], score[s], own[s], 7) for s in (slice(0, 150), slice(150, 400))]
    merged = hard.best(*[np.concatenate(x) for x in zip(*parts)], 7)
    assert all((x == y).all() for x, y in zip(whole, merged))


def test_mined_rows_equal_brute_force(spark):
    r = random.Random(2)
    rows = [(i, [r.gauss(0.1, 0.3) for _ in range(24)], r.randrange(3)) for i in range(700)]
    got = mined(made(spark, rows))
    assert got == plain(rows) and len(got) > 50


def test_mined_rows_with_many_ties_and_small_tiles(spark, monkeypatch):
    """Few different vectors, so that scores tie everywhere, over several blocks of either side."""
    monkeypatch.setattr(hard, "ANCHORS", 2)
    monkeypatch.setattr(hard, "CANDIDATES", 16)
    r = random.Random(3)
    rows = [(i, [r.choice([0.5, 0.49, 0.25]) for _ in range(2)], r.randrange(2)) for i in range(501)]
    assert mined(made(spark, rows)) == plain(rows)


def test_mined_rows_of_odd_rows(spark):
    r = random.Random(9)
    v = lambda: [r.uniform(0, 1) for _ in range(3)]
    rows = [(i, v(), i % 2) for i in range(90, 130)]
    same = v()
    rows += [(100, same, 1), (100, same, 1), (200, same, 0), (101, same, 1), (101, same, 0), (None, v(), 1), (300, v(), None),
             (400, None, 1), (102, [], 1), (103, [1.0, None, 1.0], 0), (104, [1.0, float("nan"), 1.0], 0),
             (500, [float("inf"), 1.0, 1.0], 1), (600, [1.0, 1.0], 1), (700, [0.0, 0.0, 0.0], 1), (800, [-1.0, -1.0, -1.0], 0)]
    rows += [(150, same, 0)] * 60  # repeated rows count once
    assert mined(made(spark, rows)) == plain(rows)


def test_ids_may_be_text_and_large_values_are_refused(spark):
    rows = [(f"{i:03d}", [float(i), 1.0], i % 2) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label int")
    got = hard.mine(df, F.col("vec_id") == "004", scale=1.0).collect()
    assert {x.anchor_id for x in got} == {"004"} and {x.positive_id for x in got} <= {"002", "006", "008"}
    big = spark.createDataFrame([(i, [1e9], 1) for i in range(0, 300, 50)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="64 bits"):
        mined(big)


def test_tables_without_rows_or_anchors(spark):
    assert mined(made(spark, [(1, [1.0], 1)]).limit(0)) == []
    assert mined(made(spark, [(1, [1.0], 1), (2, [1.0], 0)])) == []
