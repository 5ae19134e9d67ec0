"""Operator 8, quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (runs of 64 words, all of them).  Each passage
is encoded as a vector of shares (kinds of characters, repeated words and word
pairs, capitals, lengths), then by a learned layer; gated attention weights,
learned from the documents' labels alone, average the passages, and a logistic
unit scores the average:

    h = tanh(x E + e)        a ~ exp((tanh(h V) * sigmoid(h U)) w)
    score = sigmoid((sum a h) c + d)

The model is fitted in one task on at most ``sample`` labelled documents (those
with the smallest hashes of their ids), whole texts, full-batch Adam with a
fixed start, so the same rows give the same model.  Scoring maps over the
documents and shuffles nothing.

Edge cases: null, empty and white texts are one passage without words and get a
score like any other; labels that are null, or of documents that are not there,
teach nothing; a document with several labels is learned once per different label, documents
that share an id as one (the smallest text); with
no labelled rows, or labels of one kind, every score is the smoothed share of
label 1 (0.5 without labels); rows with null or repeated ids are scored as rows
of their own; an empty table gives an empty result; other columns are ignored; a
column that has the name of the result is replaced by it.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept_beside, slices

PASSAGE = 64
SAMPLE = 6000
HIDDEN, GATE = 16, 8
CLASSES = 7  # small letters, capitals, digits, white space, sentence marks, other marks and symbols, the rest
FEATURES = CLASSES + 9


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.full(0x110000, 6, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))
        if c in ("Lu", "Lt"):
            table[i] = 1
        elif c[0] in "LM":
            table[i] = 0
        elif c[0] == "N":
            table[i] = 2
        elif c[0] == "Z" or 9 <= i <= 13:
            table[i] = 3
        elif c[0] in "PS":
            table[i] = 5
    for c in ".,;:!?'\"-()":
        table[ord(c)] = 4
    return table


def encode(text: str | None) -> np.ndarray:
    """One row of features per passage (a text without words has one row of zeros)."""
    words = (text or "").split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    table = _classes()
    starts = range(0, len(words), PASSAGE)
    x = np.zeros((len(starts), FEATURES), np.float32)
    seen: set = set()
    for row, at in zip(x, starts):
        part = words[at:at + PASSAGE]
        n = len(part)
        joined = " ".join(part)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        kinds = np.bincount(table[codes], minlength=CLASSES)
        row[:CLASSES] = kinds / len(codes)
        counts = Counter(part)
        pairs = set(zip(part, part[1:]))
        row[CLASSES] = len(counts) / n
        row[CLASSES + 1] = max(counts.values()) / n
        row[CLASSES + 2] = len(pairs - seen) / max(1, n - 1)
        seen |= pairs
        row[CLASSES + 3] = sum(map(str.isupper, part)) / n
        row[CLASSES + 4] = sum(map(str.isalpha, part)) / n
        row[CLASSES + 5] = min(3.0, len(codes) / n / 10)
        row[CLASSES + 6] = np.log1p(n) / 4
        row[CLASSES + 7] = np.log1p(len(starts)) / 4
        row[CLASSES + 8] = min(1.0, 5.0 * kinds[5] / n)
    return x


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(p: dict, x: np.ndarray, starts: np.ndarray, of: np.ndarray) -> dict:
    """All bags at once: ``starts`` is each bag's first row, ``of`` each row's bag."""
    h = np.tanh(x @ p["E"] + p["e"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    logit = (t * g) @ p["w"]
    a = np.exp(logit - np.maximum.reduceat(logit, starts)[of])
    a /= np.add.reduceat(a, starts)[of]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}


def fit(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, rounds: int = 400, rate: float = 0.02) -> dict:
    """Full-batch Adam on the log loss of the bags, with a small weight decay."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    of = np.repeat(np.arange(len(sizes)), sizes)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / spread
    r = np.random.RandomState(8)
    p = {"E": r.normal(0, 0.3, (FEATURES, HIDDEN)), "e": np.zeros(HIDDEN), "V": r.normal(0, 0.3, (HIDDEN, GATE)),
         "U": r.normal(0, 0.3, (HIDDEN, GATE)), "w": r.normal(0, 0.3, GATE), "c": r.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}
    m1, m2 = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, rounds + 1):
        s = forward(p, x, starts, of)
        dy = (s["y"] - labels) / len(labels)
        dz = dy[:, None] * p["c"]
        da = (dz[of] * s["h"]).sum(axis=1)
        dlogit = s["a"] * (da - np.add.reduceat(s["a"] * da, starts)[of])
        dtg = dlogit[:, None] * p["w"]
        dt, dg = dtg * s["g"] * (1 - s["t"] ** 2), dtg * s["t"] * s["g"] * (1 - s["g"])
        dh = s["a"][:, None] * dz[of] + dt @ p["V"].T + dg @ p["U"].T
        dpre = dh * (1 - s["h"] ** 2)
        grad = {"E": x.T @ dpre, "e": dpre.sum(axis=0), "V": s["h"].T @ dt, "U": s["h"].T @ dg,
                "w": (s["t"] * s["g"]).T @ dlogit, "c": s["z"].T @ dy, "d": dy.sum(keepdims=True)}
        for k in p:
            g = grad[k] + 1e-4 * p[k]
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.999 * m2[k] + 0.001 * g * g
            p[k] = p[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    # the scaling of the features becomes part of the first layer
    p["e"] = p["e"] - (mean / spread) @ p["E"]
    p["E"] = p["E"] / spread[:, None]
    return p


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> dict:
    """Parameters of the model (or only ``share``, if there is nothing to tell apart).

    The sample is drawn from labels that have a document.  Of documents with one
    id the smallest text is learned from, so that an id that many rows share is
    one document of the sample."""
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
            .filter("id is not null and y in (0, 1)").filter(~held_out("id"))
            .join(own.select("id"), "id", "left_semi")
            .withColumn("o", F.xxhash64(F.col("id").cast("string"), F.lit(8)))
            .orderBy("o", "id", "y").limit(sample))
    # at most ``sample`` rows of three numbers
    texts = own.join(F.broadcast(rows), "id").groupBy("o", "id", "y").agg(F.min("text").alias("text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = [encode(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("o")), batch.column(batch.schema.get_field_index("y")),
                 pa.array([b.tobytes() for b in x], pa.binary())], names=["o", "y", "x"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["o", "y", "x"], kind="stable")
        y = pdf["y"].to_numpy(float)
        share = (y.sum() + 1) / (len(y) + 2)
        if 0 < y.sum() < len(y):
            x = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in pdf["x"]]
            p = fit(np.concatenate(x).astype(float), np.array([len(b) for b in x]), y)
        else:
            p = {}
        return pd.DataFrame({"name": ["share", *p], "shape": [[1], *[list(v.shape) for v in p.values()]],
                             "v": [[share], *[v.ravel().tolist() for v in p.values()]]})

    fitted = (texts.mapInArrow(bags, "o long, y int, x binary").withColumn("one", F.lit(1))
              .groupBy("one").applyInPandas(run, "name string, shape array<int>, v array<double>").collect())
    p = {r["name"]: np.array(r["v"]).reshape(r["shape"]) for r in fitted}
    return p or {"share": np.array([0.5])}


def score(docs: DataFrame, model: dict, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """The rows with the probability of label 1 (in place of a column of this name)."""
    kept = kept_beside(docs, out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            if "E" in model and texts:
                x = [encode(t) for t in texts]
                sizes = np.array([len(b) for b in x])
                y = forward(model, np.concatenate(x).astype(float), np.concatenate([[0], np.cumsum(sizes)[:-1]]),
                            np.repeat(np.arange(len(x)), sizes))["y"]
            else:
                y = np.full(len(texts), float(model["share"][0]))
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(y, pa.float64())], names=[*kept, out_col])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept]
    return docs.mapInArrow(run, ", ".join([*fields, f"`{out_col}` double"]))
