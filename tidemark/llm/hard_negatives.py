"""Operator 13, hard-negative mining by exact products of integer tiles.

Vectors are scaled and floored to integers.  Anchors and candidates are dealt
into blocks; each pair of blocks is one tile, whose scores come from Strassen's
recursive product: operands are padded with zeros to even sides, seven products
of half the side replace eight, and all additions are exact on int64.

* First pass: a tile keeps each anchor's ``positives`` best rows of its label.
  These short lists merge into the best of all tiles (a window whose limit is
  applied before the shuffle, too).
* Second pass: for each anchor and positive a tile keeps the ``negatives`` best
  rows of other labels inside the score window of that positive; they merge the
  same way.

The tiles are the work of a stated set of anchors against all rows, in blocks:
an anchor block is copied to each candidate block and the other way round, as
Spark rows.  A task holds one block of each side and scores it in slices of at
most ``CELLS`` products.  There are at least as many candidate blocks as shuffle
partitions, so that small tables use all cores.  Rows are dealt by their place in
a written table, so neither a label nor an id that repeats fills a block.

Edge cases: rows with a null id, a null label, a null or empty vector, or null or
non-finite components take no part, nor do vectors of another length than the
most frequent one (the shortest of those); candidates with an anchor's own id are
neither its positives nor its negatives; rows that repeat id, label and vector
count once, rows that repeat only the id are rows of their own, of which those with
equal scores count once for an anchor; ties go to the smaller id; an empty table gives an empty result; other columns are ignored,
whatever their names.  Scores that could pass int64 fail the job.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

#: rows of a block of anchors and of candidates, and scores worked out at once
ANCHORS, CANDIDATES, CELLS = 4096, 8192, 1 << 20
#: sides from which a product is split
SPLIT = 8
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= SPLIT:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p = strassen(a11 + a22, b11 + b22)
    q = strassen(a21 + a22, b11)
    r = strassen(a11, b12 - b22)
    s = strassen(a22, b21 - b11)
    t = strassen(a11 + a12, b22)
    u = strassen(a21 - a11, b11 + b12)
    v = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p + s - t + v
    out[:m, n:] = r + t
    out[m:, :n] = q + s
    out[m:, n:] = p - q + r + u
    return out


def best(group: np.ndarray, score: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best (score, id) pairs of each group, equal pairs once; what
    several tiles keep merges by another call."""
    order = np.lexsort((own, -score, group))
    group, score, own = group[order], score[order], own[order]
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (score[1:] != score[:-1]) | (own[1:] != own[:-1])
    group, score, own = group[new], score[new], own[new]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    place = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
    return group[place < k], score[place < k], own[place < k]


def _kept(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, score, id) of the ``k`` best allowed cells of each row, where no id
    stands in more than ``repeats`` cells."""
    masked = np.where(allowed, scores, _NONE)
    enough = (k - 1) * repeats + 1  # so many cells hold k ids
    if masked.shape[1] > enough:
        least = np.partition(masked, masked.shape[1] - enough, axis=1)[:, masked.shape[1] - enough]
        hit = allowed & (masked >= least[:, None])
    else:
        hit = allowed
    row, column = np.nonzero(hit)
    return best(row, masked[row, column], ids[column], k)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _values(column: pd.Series) -> np.ndarray:
    """Numbers, or text of fixed width (which sorts by code point)."""
    return np.asarray(column.tolist())


class Tile:
    """One block of anchors and one of candidates."""

    def __init__(self, rows: pd.DataFrame):
        asks = rows["asks"].to_numpy(bool)
        held = rows[~asks].drop_duplicates(["id", "label", "digest"])
        self.anchors, self.held = rows[asks], held
        self.repeats = int(held["id"].value_counts().max()) if len(held) else 1

    def scores(self):
        """Slices of candidates with the scores of all anchors."""
        a = _matrix(self.anchors["v"])
        labels, ids = _values(self.anchors["label"]), _values(self.anchors["id"])
        step = max(SPLIT, CELLS // len(a))
        for start in range(0, len(self.held), step):
            part = self.held.iloc[start:start + step]
            own, label = _values(part["id"]), _values(part["label"])
            yield (strassen(a, np.ascontiguousarray(_matrix(part["v"]).T)), own,
                   label[None, :] == labels[:, None], own[None, :] != ids[:, None])

    def __bool__(self):
        return len(self.anchors) > 0 and len(self.held) > 0


def usable(vectors: DataFrame, is_anchor: Column, scale: float, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``id``, ``label``, ``v`` (array of long), ``asks`` and ``place`` of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), label.alias("label"), v.alias("v"),
                          F.coalesce(is_anchor, F.lit(False)).alias("asks")).filter(
        "id is not null and label is not null and size(v) > 0 and "
        "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    rows = materialise(rows.select("id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("v"), "asks")
                       .withColumn("digest", F.xxhash64("v"))
                       .withColumn("place", F.monotonically_increasing_id()), "hard-rows")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (lengths[0]["n"] if lengths else 0))


def _tiles(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, extra: str) -> DataFrame:
    """Anchors and candidates with the two numbers of their tile; ``extra`` is
    what anchors carry besides."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down, across = -(-n_anchors // ANCHORS), max(-(-n_rows // CANDIDATES), min(parts, n_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asks = anchors.select((F.col("place") % down).cast("int").alias("a"), every(across).alias("c"), "*")
    held = rows.select(every(down).alias("a"), (F.col("place") % across).cast("int").alias("c"), "*")
    held = held.withColumn(extra, F.lit(None).cast(anchors.schema[extra].dataType))
    columns = ["a", "c", "id", "label", "v", "digest", "place", "asks", extra]
    return (asks.withColumn("asks", F.lit(True)).select(*columns)
            .unionByName(held.withColumn("asks", F.lit(False)).select(*columns)))


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label: Column | str = "label", scale: float = 256.0, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score`` and ``negative_score`` (long).

    ``is_anchor`` and ``label`` are columns of ``vectors``.  An anchor's
    positives are the ``positives`` best other rows of its label; a positive's
    negatives are the ``negatives`` best rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.
    """
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = usable(vectors, is_anchor, scale, id_col, vector_col, label)
    most = F.array_max(F.transform("v", F.abs))
    facts = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asks"), F.max(F.size("v")).alias("length"),
                     F.max(most).alias("most")).first()
    if not facts["asks"]:
        return rows.limit(0).select(F.col("id").alias("anchor_id"), F.col("id").alias("positive_id"), F.lit(0).alias("rank"),
                                    F.col("id").alias("negative_id"), F.lit(0).cast("long").alias("positive_score"),
                                    F.lit(0).cast("long").alias("negative_score"))
    if facts["length"] * facts["most"] ** 2 * max(100, abs(low), abs(high)) >= 1 << 63:
        raise ValueError("inner products of these vectors can pass 64 bits; use a smaller scale")
    id_type = rows.schema["id"].dataType.simpleString()

    def empty(kinds: dict) -> pd.DataFrame:
        return pd.DataFrame({c: pd.Series(dtype=t) for c, t in kinds.items()})

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        tile = Tile(pdf)
        if not tile:
            return empty({"anchor": "int64", "positive_id": object, "positive_score": "int64"})
        kept = (np.zeros(0, int), np.zeros(0, np.int64), _values(tile.held["id"])[:0])
        for scores, ids, same, other in tile.scores():
            found = _kept(scores, same & other, ids, positives, tile.repeats)
            kept = best(*[np.concatenate(pair) for pair in zip(kept, found)], positives)
        return pd.DataFrame({"anchor": tile.anchors["place"].to_numpy()[kept[0]], "positive_id": kept[2],
                             "positive_score": kept[1]})

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        tile = Tile(pdf)
        if not tile:
            return empty({"anchor": "int64", "bound": "int64", "negative_id": object, "negative_score": "int64"})
        wanted = [np.unique(np.asarray(x, np.int64)) for x in tile.anchors["bounds"]]
        bounds = np.full((len(wanted), max(map(len, wanted))), 0, np.int64)
        real = np.zeros(bounds.shape, bool)
        for i, w in enumerate(wanted):
            bounds[i, :len(w)], real[i, :len(w)] = w, True
        width = bounds.shape[1]
        kept = (np.zeros(0, int), np.zeros(0, np.int64), _values(tile.held["id"])[:0])
        for scores, ids, same, other in tile.scores():
            different = ~same & other
            for j in range(width):
                bound = bounds[:, j, None]
                allowed = (different & real[:, j, None] & (100 * scores >= low * bound) & (100 * scores <= high * bound))
                row, score, own = _kept(scores, allowed, ids, negatives, tile.repeats)
                kept = tuple(np.concatenate(pair) for pair in zip(kept, (row * width + j, score, own)))
            kept = best(*kept, negatives)
        row, j = kept[0] // width, kept[0] % width
        return pd.DataFrame({"anchor": tile.anchors["place"].to_numpy()[row], "bound": bounds[row, j],
                             "negative_id": kept[2], "negative_score": kept[1]})

    # rows that repeat id, label and vector are one anchor
    anchors = materialise(rows.filter("asks").dropDuplicates(["id", "label", "digest"]), "hard-anchors")
    plain = anchors.withColumn("bounds", F.lit(None).cast("array<bigint>"))
    found = _tiles(rows, plain, facts["n"], facts["asks"], "bounds").groupBy("a", "c").applyInPandas(
        nearest, f"anchor long, positive_id {id_type}, positive_score long").dropDuplicates()
    by_score = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    pairs = materialise(found.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= positives)
                        .drop("place"), "hard-positives")
    # at most `positives` bounds an anchor
    bounds = pairs.groupBy("anchor").agg(F.collect_set("positive_score").alias("bounds"))
    asking = materialise(anchors.join(bounds, anchors["place"] == bounds["anchor"]).drop("anchor"), "hard-asking")
    hard = _tiles(rows, asking, facts["n"], facts["asks"], "bounds").groupBy("a", "c").applyInPandas(
        inside, f"anchor long, bound long, negative_id {id_type}, negative_score long").dropDuplicates()
    by_score = Window.partitionBy("anchor", "bound").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= negatives)
    return (pairs.join(ranked, (pairs["anchor"] == ranked["anchor"]) & (pairs["positive_score"] == ranked["bound"]))
            .join(anchors.select(F.col("id").alias("anchor_id"), F.col("place")), pairs["anchor"] == F.col("place"))
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
