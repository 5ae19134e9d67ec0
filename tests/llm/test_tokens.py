"""BPE and packing against the tokenizers library and the packing's own rules."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing

ALPHABET = list(" \n\t  aab'stredllm019!?.-<|>éßññ") + ["́", "中", "😀", "\xa0", "\x1c", "\x85", "²", "ª", "Ⅷ", "　",
                                                       "<|endoftext|>", " <|endoftext|>  ", "<|startoftext|>", "'s", "'re"]


def strings(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def byte_path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def word_path():
    return public_tokenizers.path("word_bpe_49k.json")


def test_pair_index_encodes_as_the_library(byte_path):
    texts = strings(3000, 1)
    want = Tokenizer.from_file(byte_path).encode_batch(texts, add_special_tokens=False)
    got = bpe.Encoder(byte_path)(texts)
    assert [np.frombuffer(g, "<i4").tolist() for g in got] == [w.ids for w in want]


def test_round_trip_and_digests(spark, odd_docs, byte_path):
    rows = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    library = Tokenizer.from_file(byte_path)
    want = []
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
        assert back == t
    got = bpe.digests(bpe.decode(bpe.encode(odd_docs, byte_path), byte_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_decode_refuses_unknown_ids(spark, byte_path):
    df = spark.createDataFrame([(1, [10 ** 6])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not ids of this vocabulary"):
        bpe.decode(df, byte_path).collect()


def test_empty_tables(no_docs, byte_path, word_path):
    assert bpe.decode(bpe.encode(no_docs, byte_path), byte_path).count() == 0
    assert packing.pack_documents(no_docs, word_path).count() == 0


def test_word_encoder_is_the_library(word_path):
    library, encode = Tokenizer.from_file(word_path), packing.word_encoder(word_path)
    texts = strings(3000, 2)
    assert [np.frombuffer(encode(t), "<i4").tolist() for t in texts] == \
        [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_packing_is_whole_gapless_and_tight(spark, odd_docs, word_path):
    library = Tokenizer.from_file(word_path)
    rows = packing.pack_documents(odd_docs, word_path, with_ids=True).collect()
    want = []
    for r in odd_docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want.append((r.doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=str) == sorted(want, key=str)
    assert all(len(r.ids) == r.length for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_best_fit_closes_the_fullest_and_bounds_the_open_bins():
    bins = packing.BestFit(10, 2, 0)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)          # the fullest bin that can take it
    assert bins.place(9) == (2, 0)          # opens a second bin
    assert bins.place(8) == (3, 0)          # both open: the fullest (9 of 10) closes
    assert bins.place(1) == (3, 8) and bins.opened == 2
    with pytest.raises(ValueError):
        bins.place(11)


def test_packing_needs_few_sequences(spark):
    r = random.Random(4)
    lengths = [r.randint(1, 2048) if r.random() < 0.3 else r.randint(20, 700) for _ in range(20_000)]
    df = spark.createDataFrame([(n,) for n in lengths], "length long").coalesce(1)
    used = packing.pack(df).select("sequence_id").distinct().count()
    assert used <= 1.01 * sum(lengths) / 2048 + 1


def test_ids_keep_their_type(spark, word_path):
    df = spark.createDataFrame([("a", "one two"), (None, "three")], "doc_id string, text string")
    got = packing.pack_documents(df, word_path)
    assert got.schema["doc_id"].dataType.simpleString() == "string"
    assert sorted((r.doc_id for r in got.collect()), key=str) == [None, "a"]
    apart = packing.pack(packing.tokenise(df, word_path)).collect()
    assert sorted((r.id, r.ids_crc32) for r in apart if r.id) == sorted((r.doc_id, r.ids_crc32) for r in got.collect() if r.doc_id)
