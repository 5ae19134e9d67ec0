"""The pipeline stage by stage, and its registration."""

from __future__ import annotations

import __spark_entry__ as entry_module
import corpus_pipeline
from tests.conftest import SMALL
from tidemark.llm import near_dedup, pii
from tidemark.llm.common import materialise


def test_registered():
    names = list(entry_module.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "minhash_near_dedup", "pii", "best_fit_packing"]


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    odd = spark.createDataFrame([(10_000, None, None, None, None), (10_001, "12 34", "en", "s", 5)], docs.schema)
    docs = materialise(docs.unionByName(odd), "test-docs")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SMALL), f"test-{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "best_fit_packing":
            assert docs.columns == columns
        if name == "exact_dedup":
            assert docs.select("text").distinct().count() == docs.count()
        if name == "minhash_near_dedup":
            assert near_dedup.near_dedup(docs).filter("not kept").count() == 0
        if name == "pii":
            assert pii.detect(docs).filter("size(spans) > 0").count() == 0
            assert docs.filter("length(text) <> n_chars").count() == 0
    assert 10_000 not in kept["language_id"] and 10_001 not in kept["language_id"]
    assert kept["pii"] == kept["minhash_near_dedup"] == kept["best_fit_packing"] < kept["language_id"]


def test_language_stage_keeps_texts_when_no_language_can_be_learned(spark):
    rows = [(1, "some words", None), (2, "été", None), (3, "12 34", None), (4, "", None), (5, None, None), (None, "12 漢", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.keep_known_languages(spark, docs, SMALL)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, None}
