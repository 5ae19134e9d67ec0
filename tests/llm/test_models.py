"""Language ID, quality, nearest neighbours, licences, chat: held-out accuracy, brute force, round trips."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from tests.conftest import SMALL
from tests.llm.conftest import prose
from tidemark.llm import ann, chat, langid, license_scan, quality_mil
from tidemark.llm.queries import ORACLES, QUERIES


def test_language_id_held_out(spark):
    sf = SMALL.replace("0.001", "0.01")
    got = QUERIES["op9_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_id_on_odd_rows(odd_docs, no_docs):
    model = langid.train(odd_docs, may_learn=~langid.held_out("doc_id", 4, 2))
    rows = langid.predict(odd_docs.select("doc_id", "text"), model).collect()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
    assert langid.train(no_docs).predict("text") == ("und", 0.0)


def test_gram_counts_do_not_depend_on_blocks(monkeypatch):
    text = prose(5, 400)
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 100)
    parts = langid.gram_counts(text)
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_quality_held_out(spark):
    sf = SMALL.replace("0.001", "0.01")
    rows = (QUERIES["op8_quality_classifier"](spark, sf)
            .join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").collect())
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (9, 0), (10, 0), (None, 1), (11, None), (8, 1), (99, 0)], "doc_id long, quality int")
    model = quality_mil.train(odd_docs, labels)
    assert quality_mil.score(odd_docs.drop("score"), model).count() == odd_docs.count()
    nothing = quality_mil.train(odd_docs, labels.limit(0))
    assert {r.score for r in quality_mil.score(odd_docs.drop("score"), nothing).collect()} == {0.5}
    assert quality_mil.score(no_docs.drop("score"), model).count() == 0


def test_results_replace_columns_of_their_names(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", F.lit("x").alias("Score"), F.lit(1).alias("lang_pred"))
    model = langid.train(odd_docs)
    told = langid.predict(docs, model)
    assert told.columns == ["doc_id", "text", "lang_pred", "score"] and told.filter("score > 1").count() == 0
    scored = quality_mil.score(docs, {"share": np.array([0.25])})
    assert scored.columns == ["doc_id", "text", "lang_pred", "score"] and {r.score for r in scored.collect()} == {0.25}


def test_quality_sample_is_drawn_from_labels_with_documents_and_one_row_an_id(spark):
    docs = [(i, f"Some words of document {i}. " * 5 if i % 2 else "x1 x1 x1 ## " * 9) for i in range(1, 41)]
    docs += [(1, f"zz other text {k}") for k in range(50)]  # an id with most of the rows
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 41)] + [(i, 0) for i in range(1000, 3000)], "doc_id long, quality int")
    found = spark.createDataFrame(docs, "doc_id long, text string")
    few = quality_mil.train(found, labels, sample=30)
    assert "E" in few  # both labels are among the thirty, though most labels have no document
    same = quality_mil.train(found.filter("text not like 'zz%'"), labels, sample=30)
    assert all(np.array_equal(few[k], same[k]) for k in few)


def test_mil_gradient_is_that_of_differences():
    """One step of training moves every parameter against the numeric gradient of the loss."""
    r = np.random.RandomState(3)
    sizes, y = np.array([2, 5, 3, 1]), np.array([1.0, 0, 1, 0])
    x = r.normal(size=(sizes.sum(), quality_mil.FEATURES))
    starts, of = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(4), sizes)
    scaled = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-3)

    def raw(p):  # parameters on scaled features
        e = p["E"] * (x.std(axis=0) + 1e-3)[:, None]
        return {**p, "E": e, "e": p["e"] + (x.mean(axis=0) / (x.std(axis=0) + 1e-3)) @ e}

    def loss(p):
        out = quality_mil.forward(p, scaled, starts, of)["y"]
        decay = sum((v ** 2).sum() for v in p.values()) * 1e-4 / 2
        return -(y * np.log(out) + (1 - y) * np.log(1 - out)).mean() + decay

    before, after = raw(quality_mil.fit(x, sizes, y, rounds=0)), raw(quality_mil.fit(x, sizes, y, rounds=1, rate=1e-3))
    for name in before:
        for at in list(np.ndindex(before[name].shape))[:40]:
            up, down = {k: v.copy() for k, v in before.items()}, {k: v.copy() for k, v in before.items()}
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            if abs(slope) > 1e-6:  # the first step of Adam is the rate against the sign
                assert np.isclose(after[name][at] - before[name][at], -1e-3 * np.sign(slope), atol=3e-5), (name, at)


def test_language_model_follows_plain_versions():
    """FTRL by the formulas of one coordinate at a time, TF-IDF by dictionaries, the temperature by a fine search."""
    r = np.random.RandomState(2)
    model = langid.Ftrl(3)
    z, n = {}, {}
    for _ in range(60):
        rows, values, label = np.sort(r.choice(12, 4, replace=False)), r.rand(4), r.randint(3)

        def weight(i, k):
            zi, ni = z.get((i, k), 0.0), n.get((i, k), 0.0)
            if abs(zi) <= model.l1:
                return 0.0
            return -(zi - np.sign(zi) * model.l1) / ((model.beta + np.sqrt(ni)) / model.alpha + model.l2)

        logits = [sum(v * weight(i, k) for i, v in zip(rows, values)) for k in range(3)]
        p = np.exp(logits) / np.exp(logits).sum()
        old = {(i, k): weight(i, k) for i in rows for k in range(3)}
        for i, v in zip(rows, values):
            for k in range(3):
                g = v * (p[k] - (k == label))
                grown = n.get((i, k), 0.0) + g * g
                z[i, k] = z.get((i, k), 0.0) + g - (np.sqrt(grown) - np.sqrt(n.get((i, k), 0.0))) / model.alpha * old[i, k]
                n[i, k] = grown
        model.learn(rows, values, label)
    for (i, k), zi in z.items():
        assert np.isclose(model.z[i, k], zi) and np.isclose(model.n[i, k], n[i, k])
    found, counts, idf = np.array([1, 4, 9]), np.array([1, 3, 2]), np.linspace(1, 2, 1 << langid.BITS)
    plain = {b: (1 + np.log(c)) * idf[b] for b, c in zip(found, counts)}
    norm = np.sqrt(sum(v * v for v in plain.values()))
    assert np.allclose(langid.weighted(found, counts, idf), [plain[b] / norm for b in found])
    logits = r.normal(size=(400, 4)) * 6
    labels = np.array([r.choice(4, p=langid.softmax(row / 2.5)) for row in logits])
    losses = {t: -np.log(langid.softmax(logits / t)[np.arange(400), labels]).mean() for t in np.linspace(0.5, 8, 400)}
    assert abs(np.log(langid.temperature(logits, labels) / min(losses, key=losses.get))) < 0.06


def test_mil_gradient():
    r = np.random.RandomState(1)
    x, sizes, y = r.normal(size=(40, quality_mil.FEATURES)), np.array([1, 9, 20, 10]), np.array([0.0, 1, 1, 0])
    p = quality_mil.fit(x, sizes, y, rounds=200)
    s = quality_mil.forward(p, x, np.array([0, 1, 10, 30]), np.repeat(np.arange(4), sizes))
    assert (np.round(s["y"]) == y).all() and np.allclose(np.add.reduceat(s["a"], [0, 1, 10, 30]), 1)


def brute(vectors, q, k=20):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    out = {}
    for i in q:
        s = (x * x[ids == i][0]).sum(axis=1)
        ok = ids != i
        order = np.lexsort((ids[ok], -s[ok]))[:k]
        out[i] = list(zip(ids[ok][order].tolist(), s[ok][order]))
    return out


def test_nearest_neighbours_recall_and_ties(spark):
    r = np.random.RandomState(0)
    centres = r.normal(size=(12, 16))
    x = centres[r.randint(12, size=3000)] + 0.4 * r.normal(size=(3000, 16))
    x[::3] = x[0]  # a third of all rows are equal
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, range(0, 3000, 20))
    got = {}
    for row in ann.search(df, F.col("id") % 20 == 0).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        hits += len({f[1] for f in found} & {w[0] for w in want[q]})
        if q % 3 == 0:  # ties: the equal vectors with the smallest ids
            assert [f[1] for f in found] == [w[0] for w in want[q]]
    assert hits >= 0.9 * 20 * len(want)


def recall(spark, x, step=20):
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute(rows, range(0, len(x), step))
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % step == 0).collect()
    got = {(r.query_id, r.vec_id) for r in found}
    return sum((q, i) in got for q, near in want.items() for i, _ in near) / sum(map(len, want.values()))


def test_nearest_neighbours_recall_does_not_fall_with_the_number_of_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 16)
    x = np.random.RandomState(4).normal(size=(6000, 32))  # nothing but noise: distances prune little
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert min(recall(spark, x[:1000]), recall(spark, x)) >= 0.97  # about 62 and 375 lists


def test_nearest_neighbours_recall_with_unequal_lengths(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 20)
    r = np.random.RandomState(6)
    x = r.normal(size=(3000, 24))
    x *= (np.exp(r.normal(size=3000)) / np.linalg.norm(x, axis=1))[:, None]
    assert recall(spark, x) >= 0.96


def test_nearest_neighbours_walk_meets_the_nearest_lists_without_measuring_all():
    r = np.random.RandomState(7)
    middles = r.normal(size=(40, 24))
    c = ann.lengthened(middles[r.randint(40, size=2000)] + 0.5 * r.normal(size=(2000, 24)), 0.0)
    x = middles[r.randint(40, size=300)] + 0.5 * r.normal(size=(300, 24))
    exact = np.sqrt(ann._squared(ann.lengthened(x, 0.0), c))
    index = ann.Index(c, ann.neighbour_graph(c), prune=0.3)
    found, _ = index.walk(ann.lengthened(x, 0.0))
    assert np.isfinite(found).mean() < 0.5
    lists, distance = index.search(ann.lengthened(x, 0.0), 10)
    nearest = np.argsort(exact, axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(lists.tolist(), nearest.tolist())]) >= 0.95
    assert np.allclose(distance, np.take_along_axis(exact, lists, axis=1))
    probes = index.probes_of(x)  # the lists within the range of a query, and the least number
    within = exact <= 1.3 * exact.min(axis=1)[:, None]
    assert np.mean([len(set(p) & set(np.flatnonzero(w))) / w.sum() for p, w in zip(probes, within)]) >= 0.95
    assert all(len(p) >= ann.LEAST_PROBES for p in probes)


def test_nearest_neighbours_boundary_vectors_get_several_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 64)
    x = np.random.RandomState(5).normal(size=(2000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = ann.build(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>"))
    copies = np.array([len(m) for m in index.lists_of(x)])
    assert len(index.centroids) > 16 and 1.05 < copies.mean() < 2 and (copies == 1).any()


def test_nearest_neighbours_deals_rows_and_queries_of_a_long_list(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    rows = spark.range(600).selectExpr("id", "array(1D) as v", "0 as list")
    dealt = ann.tiles(rows, rows.filter("id < 300"))
    sizes = dealt.groupBy("list", "block", "part").agg(F.sum(F.expr("int(asks)")).alias("q"), F.count("*").alias("n")).collect()
    assert len(sizes) == 12 * 6 and all(0 < r.q < 100 and 0 < r.n - r.q < 100 for r in sizes)
    pairs = dealt.filter("not asks").join(dealt.filter("asks").selectExpr("list", "block", "part", "id as q"), ["list", "block", "part"])
    assert pairs.count() == pairs.select("id", "q").distinct().count() == 600 * 300


def test_nearest_neighbours_on_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0]), (20, [float("inf"), 0.0]), (7, [0.5, 0.5]), (40, [0.0, 1.0]), (8, [])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, list int")
    got = [tuple(r) for r in ann.search(df, F.col("id") % 20 == 0).collect()]
    assert sorted(got) == [(0, 1, 1, 0.5), (0, 2, 7, 0.5), (0, 3, 40, 0.0), (40, 1, 1, 0.5), (40, 2, 7, 0.5), (40, 3, 0, 0.0)]
    assert ann.search(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_license_scan_and_oracle(spark, odd_docs, no_docs):
    got = {r.doc_id: (r.license, r.containment) for r in license_scan.license_scan(odd_docs).collect()}
    assert got == {13: ("CC-BY-NC-4.0", 1.0)}
    assert license_scan.license_scan(no_docs).count() == 0
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SMALL}/documents.parquet')")
    want = con.execute(ORACLES["op6_license_scan"]).fetchall()
    cols = ["doc_id", "license", "containment", "first_word", "n_windows"]
    found = QUERIES["op6_license_scan"](spark, SMALL).select(*cols).collect()
    assert sorted(map(tuple, found)) == sorted(tuple(w) for w in want)


def test_license_oracle_agrees_on_all_notices_with_mixed_families(spark):
    """Every notice, alone, changed by a word, beside another one of any family, and with another version."""
    r = random.Random(9)
    texts = []
    for i, (_, text) in enumerate(license_scan.NOTICES):
        words = text.split()
        changed = list(words)
        changed[r.randrange(len(words))] = "otherwise"
        other = r.choice(license_scan.NOTICES)[1]
        texts += [f"{prose(i, 4 + i % 9)} {text} {prose(i + 80, 6)}", f"{prose(i, 3)} {' '.join(changed)} {prose(i, 8)}",
                  f"{text} {prose(i, i % 40)} {other}", f"{text} {text}", re.sub("[0-9]", "7", text)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [tuple(x) for x in license_scan.license_scan(docs).select("doc_id", "license", "containment", "first_word", "n_windows")
             .collect()]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(texts))), "text": texts}))
    want = con.execute("select doc_id, license, containment, first_word, n_windows from (" + ORACLES["op6_license_scan"] + ")").fetchall()
    assert len(want) > len(license_scan.NOTICES) and any("unclear" in w[1] for w in want)
    assert sorted(found) == sorted(want)


def test_license_scan_finds_changed_and_embedded_notices(spark):
    notice = dict(license_scan.TEMPLATES[::-1])["GPL-3.0"].split()
    long = license_scan.TEMPLATES[5][1].split()
    r = random.Random(2)
    rows = []
    for i in range(40):
        w = list(long)
        w[r.randrange(len(w))] = "otherwise"
        rows.append((i, f"{prose(i, r.randrange(90))} {' '.join(w)} {prose(i + 50, 30)}"))
    rows.append((100, " ".join(notice[:4])))
    got = {x.doc_id for x in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(range(40))


def test_license_scan_tells_versions_and_families_apart(spark):
    alone = {i: (name, text) for i, (name, text) in enumerate(license_scan.NOTICES)}
    other = {200: ("LicenseRef-GNU-unclear", "This work is licensed under the GNU General Public License, version 1."),
             201: ("LicenseRef-Apache-unclear", "Licensed under the Apache License, Version 2.1.")}
    rows = [(i, f"{prose(i, 7 + i % 5)} {text} {prose(i + 300, 9)}") for i, (_, text) in {**alone, **other}.items()]
    two = "This work is licensed under the GNU General Public License, version "
    rows.append((300, f"{two}2. {two}3."))
    got = {}
    for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert got.pop(300) == {"GPL-2.0", "GPL-3.0"}
    assert got == {i: {name} for i, (name, _) in {**alone, **other}.items()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<s>"]),
                          st.lists(st.sampled_from([*chat.CONTROLS, "\\", "a", " ", "<", ">", "[", "]", "/", "\n", "s"])).map("".join)),
                max_size=6))
def test_template_is_reversible(turns):
    whole = "".join("".join(chat.marked(*t)) for t in turns)
    assert chat.parse(whole) == turns


def test_chat_forest_shares_prefixes_and_reads_back(spark):
    rows = []
    for c in range(60):
        first = "hello" if c % 3 else f"start {c}"
        rows += [(c, 0, "user", first), (c, 1, "assistant", f"answer {c % 5}"), (c, 2, "user", None), (c, 3, "assistant", f"</s> {c % 7}")]
    rows += [(None, 0, "user", "x"), (70, None, None, "no turn"), (70, 1, "assistant", "y"), (70, 1, "assistant", "y")]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "conv_id long, turn long, role string, text string, depth int, node string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    forest = chat.build_forest(df, path)
    prefixes = {tuple((r[2] or "", r[3] or "") for r in rows if r[0] == c)[:n] for c in {r[0] for r in rows} for n in range(1, 5)}
    nodes = forest.nodes.collect()
    assert len(nodes) == len({p for p in prefixes if p})
    spans = sorted((n.start, n.start + len(n.ids)) for n in nodes)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))  # every token once, no gaps
    for p in forest.paths.collect():
        at = 0
        for i in sorted(p.intervals, key=lambda i: i.position):
            assert i.position == at
            at += i.stop - i.start
        starts = [i.start for i in sorted(p.intervals, key=lambda i: i.position)]
        assert starts == sorted(starts)  # depth first: a node stands after its ancestors
    got = {r.conv_id: r for r in chat.digests(forest, path).collect()}
    assert got[None].n_turns == 1 and got[70].n_turns == 3 and got[0].loss_chars == len("answer 0</s> 0")
    assert chat.digests(chat.build_forest(df.limit(0), path), path).count() == 0


def test_chat_takes_a_very_long_conversation(spark):
    """Work is linear in the turns of a conversation: folds over arrays took minutes here."""
    n, path = 40_000, public_tokenizers.path("byte_bpe_50k.json")
    said = [("user" if k % 2 == 0 else "assistant", f"turn {k % 1000} </s>") for k in range(n)]
    df = spark.range(n).selectExpr("1L AS conv_id", "int(id) AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
                                   "concat('turn ', id % 1000, ' </s>') AS text")
    df = df.unionByName(df.filter("turn < 3").withColumn("conv_id", F.lit(2).cast("long")))
    forest = chat.build_forest(df, path)
    paths = {r.leaf: r.intervals for r in forest.paths.collect()}
    for intervals in paths.values():
        at = 0
        for i in intervals:
            assert i.position == at
            at += i.stop - i.start
    got = {r.conv_id: r for r in chat.digests(forest, path).collect()}
    for conv, turns in ((1, said), (2, said[:3])):
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].formatted_chars == sum(len("".join(chat.marked(*t))) for t in turns)
