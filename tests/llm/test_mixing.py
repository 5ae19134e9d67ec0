"""Source mixing against a plain version of its rules."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

from tidemark.llm import mixing


def plain_targets(sizes: dict, share=1.5, most=2.0, weights=(3, 1, 2)) -> dict:
    """Shared out round by round: what is above a source's limit goes back to the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: set = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_weight = sum(w[s] for s in order if s not in full)
        deal = {s: left * w[s] / open_weight for s in order if s not in full}
        over = {s for s in deal if deal[s] > most * sizes[s]}
        if not over:
            return {**deal, **{s: most * sizes[s] for s in full}}
        full |= over


def check(rows, got):
    def draw(i, t):
        key = str(i) if i is not None else hashlib.md5((t or "").encode()).hexdigest()
        return int(hashlib.md5(f"11:{key}".encode()).hexdigest()[:13], 16) / 2 ** 52

    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    target = plain_targets(sizes)
    want = []
    for i, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        copies = math.floor(rate + 1e-12) + (draw(i, t) < rate - math.floor(rate + 1e-12))
        want.append((i, n, sizes[s], round(target[s], 6), copies, copies * n))
    got = [(r.doc_id, r.size, r.source_size, round(r.target, 6), r.copies, r.taken) for r in got]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_mix_equals_the_rules_dealt_round_by_round(spark):
    r = random.Random(8)
    rows = []
    for i in range(1500):
        s = r.choice(["a", "B", "é", "z" * 3, None, "hot", "hot", "hot", "rare" if r.random() < 0.02 else "a"])
        rows.append((i, " ".join(["w"] * r.randint(0, 60)), s))
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    check(rows, got)
    by = defaultdict(lambda: [0, 0.0, 0.0])
    for x in got:
        by[x.source_size][0] += x.taken
        by[x.source_size][1] = x.target
        by[x.source_size][2] += x.size ** 2 * (x.rate % 1) * (1 - x.rate % 1)
        assert x.taken <= 2 * x.size
    for taken, target, variance in by.values():
        assert abs(taken - target) <= 5 * math.sqrt(variance) + 1e-6


def test_mix_of_odd_rows_and_the_rows_it_emits(spark, odd_docs):
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    mixed = mixing.mix(odd_docs).collect()
    check(rows, mixed)
    again = mixing.mix(odd_docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))
    out = mixing.emit(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == sum(x.copies for x in mixed)


def test_sources_without_words_and_empty_tables(spark, no_docs):
    rows = [(1, None, "a"), (2, " \n", "a"), (3, "x y", "b")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    check(rows, got)
    none = [(1, None, None), (None, "", "a")]
    check(none, mixing.mix(spark.createDataFrame(none, "doc_id long, text string, source string")).collect())
    assert mixing.mix(no_docs).count() == 0 and mixing.emit(no_docs).count() == 0


def test_many_sources_fill_up_in_turns(spark):
    """A chain of sources of very different sizes, so that each round of dealing fills a few more."""
    rows = [(i, "w " * (2 ** (i % 12)), f"s{i % 240:03d}") for i in range(480)]
    check(rows, mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
