"""Operator 5, BPE encoding and decoding with a pair occurrence index.

Texts are cut into words by the vocabulary's pattern.  The different words of a
slice of a partition are laid out one after the other, and an index maps each
mergeable pair to all its positions.  The active ranks are applied in ascending
order: all positions of the pair are merged at once, and only the lists of the
pairs to the left and right of a merge are changed.  Words that a task has seen
before keep their ids (a bounded cache).  No row leaves its partition.

Encoding equals the ``tokenizers`` library's for a byte-level vocabulary with
``add_special_tokens=False``: a special token's string in a text becomes that
token.  Decoding concatenates the tokens' bytes and replaces what is not UTF-8.

Edge cases: a null or empty text has no ids and decodes to the empty text;
rows with null or repeated ids are encoded as rows of their own; an unknown or
null id in a list to decode is an error naming it; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import WS
from tidemark.llm.common import id_and_text, slices

SLICE_BYTES = 4 << 20
#: words whose ids a task remembers, in each of two generations
CACHE = 350_000

# fixed values: the contractions that byte-level vocabularies split off
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]

# texts of white space, printable ASCII and Latin-1 letters need no Unicode tables
_PLAIN = re.compile("[\t-\r !-~À-ÖØ-öø-ÿ]*")
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN_WORDS = re.compile("|".join([*CONTRACTIONS, f" ?[{_LATIN}]+", " ?[0-9]+", rf" ?[^{_LATIN}0-9\s]+",
                                    r"\s+(?!\S)", r"\s+"]))


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    itself if printable in Latin-1, else the next from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=1)
def _any_words():
    import regex

    white = r"\t-\r \x85\xa0  -     　"
    return regex.compile("|".join([*CONTRACTIONS, r" ?\p{L}+", r" ?\p{N}+", rf" ?[^{WS}\p{{L}}\p{{N}}]+",
                                   f"[{WS}]+(?![^{WS}])", f"[{WS}]+"]))


class Vocabulary:
    """A byte-level vocabulary read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec.get("added_tokens", [])
        vocab: dict[str, int] = model["vocab"]
        of_char = {c: b for b, c in enumerate(byte_alphabet())}
        self.byte_ids = np.array([vocab[c] for c in byte_alphabet()], np.int64)
        self.special = {t["content"]: t["id"] for t in added}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes | None] = [None] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(of_char[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        #: by rank: left, right and merged id; by pair (left << 32 | right): rank
        self.merges: list[tuple[int, int, int]] = []
        self.rank_of: dict[int, int] = {}
        made_at: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, new = vocab[left], vocab[right], vocab[left + right]
            if max(made_at.get(a, -1), made_at.get(b, -1)) >= rank:
                raise ValueError("a merge uses a token that only a later merge makes")
            made_at.setdefault(new, rank)
            self.merges.append((a, b, new))
            self.rank_of[a << 32 | b] = rank
        #: rank of each pair of bytes, or -1
        self.byte_ranks = np.array([[self.rank_of.get(int(a) << 32 | int(b), -1) for b in self.byte_ids]
                                    for a in self.byte_ids], np.int64)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_words(words: Iterable[bytes], vocab: Vocabulary) -> list[array]:
    """The ids of each word, by one pair occurrence index over all of them."""
    END, GONE = -1, -2
    rank_of, merges = vocab.rank_of, vocab.merges
    words = list(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    held = np.frombuffer(b"".join(words), np.uint8)
    word = np.repeat(np.arange(len(words)), lengths)
    # every word stands between two end marks
    at = np.arange(len(held)) + word + 1
    size = len(held) + len(words) + 1
    symbols = np.full(size, END, np.int64)
    symbols[at] = vocab.byte_ids[held]
    symbols = symbols.tolist()
    starts = (np.cumsum(lengths) - lengths + np.arange(len(words)) + 1).tolist()
    after, before = array("i", range(1, size + 1)), array("i", range(-1, size - 1))
    places: dict[int, list[int]] = {}
    rank = np.where(word[:-1] == word[1:], vocab.byte_ranks[held[:-1], held[1:]], -1)
    mergeable = np.flatnonzero(rank >= 0)
    if len(mergeable):
        order = mergeable[np.argsort(rank[mergeable], kind="stable")]
        found, first = np.unique(rank[order], return_index=True)
        places = dict(zip(found.tolist(), (p.tolist() for p in np.split(at[order], first[1:]))))
    active = list(places)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        left, right, new = merges[rank]
        held = places.pop(rank)
        if left == right:  # overlapping places merge from the left
            held.sort()
        for at in held:
            if symbols[at] != left:
                continue
            second = after[at]
            if symbols[second] != right:
                continue
            symbols[at], symbols[second] = new, GONE
            follower = after[at] = after[second]
            before[follower] = at
            preceder = before[at]
            if symbols[preceder] >= 0:
                found = rank_of.get(symbols[preceder] << 32 | new)
                if found is not None:
                    if found in places:
                        places[found].append(preceder)
                    else:
                        places[found] = [preceder]
                        heapq.heappush(active, found)
            if symbols[follower] >= 0:
                found = rank_of.get(new << 32 | symbols[follower])
                if found is not None:
                    if found in places:
                        places[found].append(at)
                    else:
                        places[found] = [at]
                        heapq.heappush(active, found)
    out = []
    for k, start in enumerate(starts):
        stop = (starts[k + 1] if k + 1 < len(starts) else size) - 1
        out.append(array("i", [s for s in symbols[start:stop] if s >= 0]))
    return out


class Encoder:
    def __init__(self, path: str, cache_limit: int = CACHE):
        self.vocab, self.limit = vocabulary(path), cache_limit
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        special = sorted(self.vocab.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    @staticmethod
    def words(text: str) -> list[str]:
        return _PLAIN_WORDS.findall(text) if _PLAIN.fullmatch(text) else _any_words().findall(text)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as int32 bytes."""
        special, known = self.vocab.special, self.known
        split: list[list[str]] = []
        marked: set[int] = set()
        for k, text in enumerate(texts):
            if self.special is not None and self.special.search(text):
                marked.add(k)
                split.append([w for part in self.special.split(text)
                              for w in ([part] if part in special else self.words(part))])
            else:
                split.append(self.words(text))
        new = set().union(*split).difference(known)
        if len(known) + len(new) > self.limit:  # what was used lately stays one generation longer
            self.older, self.known = known, {}
            known, new = self.known, set().union(*split)
        missing = []
        for w in new:
            ids = self.older.get(w)
            if ids is None:
                missing.append(w)
            else:
                known[w] = ids
        # a special token's string can stand here only for the token: the pattern cuts it elsewhere
        for word, ids in zip(missing, merge_words([w.encode("utf-8", "replace") for w in missing], self.vocab)):
            known[word] = ids.tobytes()
        for k in marked:
            split[k] = [w if w not in special else "\0" + w for w in split[k]]
        for token, i in special.items():
            known["\0" + token] = array("i", [i]).tobytes()
        return [b"".join(map(known.__getitem__, w)) for w in split]


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocab_path)
        for batch in slices(batches, SLICE_BYTES):
            parts = encoder(batch.column(1).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype("int32")
            ids = pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), ids)], names=["id", "ids"])

    texts = id_and_text(docs, id_col, text_col)
    key = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {key}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocab_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows with the text of their ids in ``out_col`` (a null list is the empty text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = vocabulary(vocab_path).token_bytes
        for batch in slices(batches, SLICE_BYTES):
            column = batch.column(batch.schema.get_field_index(ids_col))
            texts = []
            for row in range(batch.num_rows):
                ids = column[row].values
                try:
                    found = [token[i] for i in ids.to_numpy(zero_copy_only=False).tolist()] if ids is not None else []
                    texts.append(b"".join(found).decode("utf-8", "replace"))
                except (IndexError, TypeError) as e:
                    raise ValueError(f"not ids of this vocabulary: {ids}") from e
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, out_col])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields]
    return encoded.mapInArrow(run, ", ".join([*fields, f"`{out_col}` string"]))


def digests(decoded: DataFrame, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Replace ids and text by their number and SHA-256."""
    keep = [c for c in decoded.columns if c not in (ids_col, text_col)]
    return decoded.select(*keep, F.size(ids_col).cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col(ids_col).cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2(text_col, 256).alias("decoded_sha256"))
