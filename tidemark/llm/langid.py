"""Operator 9, language ID: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader and elastic-net
penalties, then calibrated by a temperature.

* Features: the text in lower case, every run of non-letters one space; the
  character n-grams of orders 1 to 3 hashed to 2^15 buckets; (1 + ln tf) * idf,
  scaled to length one.  Whole texts are read, in blocks whatever their length.
* Document frequencies and the documents of each language are counted over all
  training rows: each task adds up its own and sends one row per bucket.
* The weights are fitted on at most ``per_language`` training rows of each
  language (a bounded sample: those with the smallest hashes of their ids), in
  one task.  A fifth of the sample is held back for the temperature.
* Scoring maps over the documents; weights and idf (2^15 rows) go along.

Edge cases: null or empty texts and texts without a letter are ``und`` with
score 0; null languages and null ids teach nothing; without training rows
everything is ``und``; rows with repeated ids are scored as rows of their own;
of equal scores the language first in alphabetical order wins; an empty table
gives an empty result; other columns are ignored, whatever their names; columns
that have the names of the results are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept_beside, slices

BITS = 15
ORDERS = 3
PER_LANGUAGE = 1500
BLOCK = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The code point itself for letters, a space for all else."""
    table = np.arange(0x110000, dtype=np.uint32)
    table[[i for i in range(0x110000) if not chr(i).isalpha()]] = 32
    return table


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams and their counts."""
    size, shift = 1 << BITS, np.uint32(32 - BITS)
    codes = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    if len(codes):
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint32)
    counts = np.zeros(size, np.int64)
    for start in range(0, len(codes), BLOCK):
        part = codes[start:start + BLOCK + ORDERS - 1]
        own = min(BLOCK, len(codes) - start)  # n-grams that begin in this block
        h = np.zeros(len(part), np.uint32)
        for n in range(1, ORDERS + 1):
            ends = part[n - 1:]
            h = (h[:len(ends)] ^ (ends + np.uint32(n))) * np.uint32(0x9E3779B1)
            h = h ^ (h >> np.uint32(15))
            counts += np.bincount((h[:own] * np.uint32(0x85EBCA77)) >> shift, minlength=size)
    found = np.flatnonzero(counts)
    return found, counts[found]


def weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1.0 + np.log(counts)) * idf[found]
    norm = np.sqrt((values ** 2).sum())
    return values / norm if norm else values


@dataclass
class Ftrl:
    """Multinomial FTRL-proximal: per-coordinate step sizes; the weights come
    from the sums of gradients by soft thresholding (L1) and shrinking (L2)."""

    classes: int
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4

    def __post_init__(self):
        self.z = np.zeros(((1 << BITS) + 1, self.classes))  # the last row is the intercept
        self.n = np.zeros_like(self.z)

    def weights(self, rows) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, rows: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(rows)
        p = softmax(values @ w)
        p[label] -= 1
        g = values[:, None] * p
        n = self.n[rows]
        grown = n + g * g
        self.z[rows] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[rows] = grown


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log likelihood, on a fine grid."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (buckets + 1, languages)
    temperature: float

    def logits(self, found, counts) -> np.ndarray:
        return weighted(found, counts, self.idf) @ self.weights[found] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        p = softmax(self.logits(*gram_counts(text)) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          may_learn: Column | None = None, per_language: int = PER_LANGUAGE, epochs: int = 3) -> Model:
    """Fit on the rows with a label and ``may_learn`` true."""
    if may_learn is not None:
        docs = docs.filter(may_learn)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{label_col}`").alias("lang")).filter("id is not null and lang is not null")
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(per_lang)
    total = sum(per_lang.values())
    if not languages:
        return Model([], np.zeros(1 << BITS), np.zeros(((1 << BITS) + 1, 0)), 1.0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    df[gram_counts(text)[0]] += 1
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype("int32")), pa.array(df[found])], names=["b", "n"])

    df = np.zeros(1 << BITS)
    for r in rows.select("text").mapInArrow(frequencies, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():
        df[r["b"]] = r["n"]
    idf = np.log((1 + total) / (1 + df)) + 1

    # a little above the bound by rate, then exactly the bound by rank of the hash
    order = F.xxhash64(F.col("id").cast("string"), F.lit(9))
    rate = F.create_map(*[F.lit(x) for lang, n in per_lang.items()
                          for x in (lang, min(1.0, 1.3 * (per_language + 50) / n))])
    sample = (rows.withColumn("o", order)
              .filter((F.col("o") / F.lit(2.0 ** 64) + 0.5) < rate[F.col("lang")]))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, where, many = [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                if text and any(map(str.isalpha, text)):
                    found, counts = gram_counts(text)
                    kept.append(k)
                    where.append(found.astype("<u2").tobytes())
                    many.append(counts.astype("<u4").tobytes())
            part = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(where, pa.binary()), pa.array(many, pa.binary())],
                names=["o", "lang", "f", "c"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["o", "lang", "f"], kind="stable")
        pdf = pdf[pdf.groupby("lang").cumcount() < per_language]
        of = {lang: i for i, lang in enumerate(languages)}
        examples = []
        for f, c, lang in zip(pdf["f"], pdf["c"], pdf["lang"]):
            found = np.frombuffer(f, "<u2").astype(np.int64)
            values = weighted(found, np.frombuffer(c, "<u4"), idf)
            examples.append((np.append(found, 1 << BITS), np.append(values, 1.0), of[lang]))
        held = examples[::5] if len(examples) >= 50 else []
        taught = [e for i, e in enumerate(examples) if i % 5] if held else examples
        model = Ftrl(len(languages))
        for _ in range(epochs):
            for e in taught:
                model.learn(*e)
        weights = model.weights(slice(None))
        t = temperature(np.array([v @ weights[r] for r, v, _ in held]), np.array([y for *_, y in held], int))
        return pd.DataFrame({"w": [weights.astype("<f4").tobytes()], "t": [t]})

    fitted = (sample.select("o", "text", "lang").mapInArrow(features, "o long, lang string, f binary, c binary")
              .withColumn("one", F.lit(1)).groupBy("one").applyInPandas(fit, "w binary, t double").collect())
    if not fitted:
        return Model([], idf, np.zeros(((1 << BITS) + 1, 0)), 1.0)
    weights = np.frombuffer(fitted[0]["w"], "<f4").reshape(-1, len(languages)).astype(float)
    return Model(languages, idf, weights, fitted[0]["t"])


def predict(docs: DataFrame, model: Model, text_col: str = "text", out_cols: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The rows with the predicted language and its probability (in place of columns of these names)."""
    kept = kept_beside(docs, *out_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            found = [model.predict(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(kept).columns, pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=[*kept, *out_cols])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept]
    return docs.mapInArrow(run, ", ".join([*fields, f"`{out_cols[0]}` string", f"`{out_cols[1]}` double"]))


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether a row is kept from learning, by the CRC-32 of its id as text (null ids: not)."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % modulus == remainder, F.lit(False))
