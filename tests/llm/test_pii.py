"""Personal data: base spans against Python's re, the model, masking."""

from __future__ import annotations

import hashlib
import math
import random
import re

from tidemark.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), place, kind, m.end()))
    return sorted(out)


def test_base_spans_are_the_contracts(spark, odd_docs):
    r = random.Random(3)
    parts = ["a", "@", ".", "-", "+", "1", "2", "4", "0", "%", "_", " ", "(", ")", "é", "255", "256", "abc.de", "\n", "😀",
             "4111 1111 1111 1111", "1.2.3.4", "+1 (614) 555-8001", "a@b.co", 'token = "deadbeefdeadbeef1234"']
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 25)))) for i in range(1500)]
    rows += [(9000, None), (9001, "a@b" + ".c" * 3000), (9002, "1" * 20000), (9003, "x" * 20000 + "@a.b"), (9004, "a@b.c " * 500)]
    got = {x.doc_id: x for x in pii.digests(pii.detect(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        spans = base_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(s[2] == k for s in spans) for k in BASE]
        assert set(filter(None, joined.split(","))) <= set(got[i].spans.split(","))


def test_odd_rows_and_empty_tables(odd_docs, no_docs):
    assert pii.detect(odd_docs).count() == odd_docs.count()
    assert pii.detect(no_docs).count() == 0


def test_added_spans_and_masking(spark):
    rows = [(i, f'see token = "{i:040x}" and mail me{i}@mail.example.com or +1 (614) 555-80{i:02d}') for i in range(30)]
    rows += [(100 + i, "plain words with version 1.2.3 and order 4111 1111 1111 1112") for i in range(30)]
    rows += [(200 + i, f"the key AKIAPTDW4XUFB63SM{i:02d}H stands here, password={hashlib.md5(str(i).encode()).hexdigest()[:18]} too") for i in range(10, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = {r.doc_id: [s.kind for s in r.spans] for r in pii.detect(df).collect()}
    assert all(kinds[i] == ["secret", "email", "phone"] for i in range(30))
    assert all(kinds[100 + i] == [] for i in range(30))
    assert all(kinds[200 + i] == ["secret", "secret"] for i in range(10, 30))
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[3] == "see [secret] and mail [email] or [phone]" and masked[101] == rows[31][1]


def test_reliabilities_follow_the_labelers():
    counts = {"email yyyyy": 900, "email yynyy": 50, "ssn nn-nn": 500, "ssn yy-yy": 300, "ssn yn-y-": 10}
    p = pii.estimate_reliability(counts)
    assert p["email yyyyy"] > 0.95 and p["ssn yy-yy"] > 0.8 and p["ssn nn-nn"] < 0.1


def test_classifier_weights_are_the_log_ratios_of_shares():
    kind = pii.KINDS.index("secret") * pii.WIDTH
    sums = {kind: (90.0, 30.0), kind + 1: (60.0, 0.0), kind + 2: (30.0, 30.0)}
    w = pii.train_classifier(sums)
    assert math.isclose(w[kind], math.log(91 / 31)) and w[0] == 0
    share = (60 + 1) / (120 + pii.BUCKETS)
    assert math.isclose(w[kind + 1], 0.5 * math.log(((60 + 8 * share) / 98) / (8 * share / 38)))
    assert w[kind + 1] > 0 > w[kind + 2]


def test_classifier_learns_from_surroundings_that_no_labeler_sees(spark):
    """The same forms, with and without votes of the labelers; words around them tell the classifier which are secrets."""
    r = random.Random(7)
    key = "".join
    rows = [(i, "service uses token = " + key(r.choice("abcdef0123456789") for _ in range(32)) + " for signing") for i in range(300)]
    rows += [(1000 + i, "release notes mention token: " + r.choice(["transformer", "embedding", "vocabulary"]) + " sizes") for i in range(300)]
    got = {x.doc_id: x.n_secret for x in pii.digests(pii.detect(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(got[i] == 1 for i in range(300)) and all(got[1000 + i] == 0 for i in range(300))


def test_classifier_uses_no_votes(spark):
    """Spans with equal surroundings and form have equal features, whatever the votes."""
    rows = [(1, "my ssn is 123-45-6789 ok"), (2, "my ssn is 123-45-1111 ok"), (3, "my ssn is 000-45-6789 ok")]
    spans = {x.id: x.spans[0] for x in pii.candidates(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
             .collect()}
    assert spans[1].features[:5] == spans[2].features[:5] == spans[3].features[:5] and spans[1].code != spans[3].code
    assert all(0 <= f - pii.KINDS.index("ssn") * pii.WIDTH < pii.WIDTH for s in spans.values() for f in s.features)
    assert spans[1].formed and not spans[3].formed


def test_many_matches_in_one_text_take_linear_time(spark):
    """200,000 matches of three kinds in one text of some megabytes; spans at their places."""
    import time

    n = 66_667
    part = "u{0}@ex.org 10.0.{1}.7 +49 30 1234{0:07d}; "
    text = "".join(part.format(i, i % 250) for i in range(n))
    df = spark.createDataFrame([(1, text), (2, "1 22 333 " * 90_000)], "doc_id long, text string")
    began = time.monotonic()
    rows = {r.doc_id: r for r in pii.digests(pii.detect(df)).collect()}
    assert time.monotonic() - began < 120
    assert (rows[1].n_email, rows[1].n_ip, rows[1].n_phone) == (n, n, n) and rows[2].n_card == 0
    at, want = 0, []
    for i in range(n):
        words = part.format(i, i % 250)
        want.append(f"email:{at}:{at + words.index(' ')}")
        at += len(words)
    assert [s for s in rows[1].spans.split(",") if s.startswith("email:")] == want


def test_weights_are_a_literal_in_the_plan(spark, odd_docs):
    """The table of weights is read once, not once per span."""
    plan = pii.detect(odd_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan
