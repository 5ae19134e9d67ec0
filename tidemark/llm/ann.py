"""Operator 2, approximate nearest neighbours over balanced posting lists.

* Centroids are fitted on a bounded sample (``SAMPLE`` vectors at most, those
  with the smallest hashes of their ids) by k-means with a penalty on full
  clusters; there is one for about ``LIST`` vectors of the table, at most
  ``MAX_LISTS``.  Vectors of all lengths get one more component that brings them
  to the length of the longest (queries get 0), so that the nearest ones are
  those with the largest inner product; all and the centroids are then scaled to
  length one: means of many vectors are short and close together, and distances
  to them would hardly differ.  Centroids are searched by a walk on an in-memory
  graph of their nearest neighbours, for vectors to be indexed and for queries
  alike and at every size; it goes to the tasks by value (at most MAX_LISTS rows).
* Every vector is indexed: it goes to its nearest list, and to further ones
  whose distance is at most ``1 + replicate`` times the nearest, unless the
  list's centroid is nearer to a centroid already chosen than ``APART`` times
  the vector is (at most ``COPIES``).  ``replicate`` is measured on the sample:
  a share ``BOUNDARY`` of it has a second list so near, ``REPLICATE`` at most.
* A query searches all lists met by the walk whose distance is at most
  ``1 + prune`` times its nearest list's, and the nearest ``LEAST_PROBES`` in any case.  ``prune`` is
  measured for each table: ``ASKED`` queries are answered by a scan of all rows,
  and it is the least value at which ``RECALL`` of their neighbours lie in lists
  that are searched.  There is no other limit to the number of lists.
* Lists longer than ``BLOCK`` rows, as many equal vectors make, are dealt over
  several blocks, and so are the queries of a list; each block of queries meets
  each block of rows.  Each pair of blocks returns a query's ``k`` best, and the
  best of those are the result.

Scores are inner products in double precision on the original vectors.
Prefiltering inside a block uses a matrix product with a margin; the rows that
can be in the result are scored one by one, so equal vectors have equal scores.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, as queries or as candidates; rows with null ids take
no part; vectors of other lengths than the most frequent one take no part;
rows that repeat both id and vector count once, other rows with the same id are
candidates of their own (never of a query with the
same id); ties go to the smaller id; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

SAMPLE = 32_768
LIST = 512
MAX_LISTS = 8192
COPIES, REPLICATE, BOUNDARY, APART = 4, 0.15, 0.1, 0.8
FITTED = 8192
LEAST_PROBES, ASKED, RECALL = 8, 128, 0.99
NEAR = 0.1
BLOCK = 4096
DEGREE = 16
BEAM = 48
#: pairs of vector and list measured at once
LOOKED = 1 << 17


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with a component that makes them as long as the longest, scaled to length one."""
    rest = np.sqrt(np.maximum(longest ** 2 - (x * x).sum(axis=1), 0))
    # what rounding leaves of equal lengths is none
    return unit(np.column_stack([x, np.where(rest > 1e-6 * longest, rest, 0)]))


def balanced_centroids(x: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """k-means on the unit sphere whose assignment adds to a distance what a cluster already holds beyond its share."""
    x = np.unique(unit(x), axis=0)
    r = np.random.RandomState(2)
    lists = min(lists, len(x))
    c = x[r.choice(len(x), lists, replace=False)]
    load, share = np.zeros(lists), len(x) / lists
    for _ in range(rounds):
        scale = 0.0
        total, count = np.zeros_like(c), np.zeros(lists)
        for start in range(0, len(x), 2048):
            part = x[start:start + 2048]
            d = _squared(part, c)
            scale = scale or float(np.median(d.min(axis=1)))
            nearest = (d + scale * 0.2 * np.maximum(load / share - 1, 0)).argmin(axis=1)
            np.add.at(total, nearest, part)
            count += np.bincount(nearest, minlength=lists)
        c = np.where((total != 0).any(axis=1)[:, None], unit(total), x[r.randint(len(x), size=lists)])
        load = count
    return c


def neighbour_graph(c: np.ndarray) -> np.ndarray:
    """The nearest centroids of each centroid, the next one in the list, so that
    every one can be reached, and a few far ones, so that a walk gets anywhere soon."""
    degree = min(DEGREE, len(c) - 1)
    if degree < 1:
        return np.zeros((len(c), 0), np.int64)
    near = np.empty((len(c), degree), np.int64)
    for start in range(0, len(c), 1024):
        d = _squared(c[start:start + 1024], c)
        d[np.arange(len(d)), np.arange(start, start + len(d))] = np.inf
        near[start:start + 1024] = np.argpartition(d, degree - 1, axis=1)[:, :degree]
    far = np.random.RandomState(3).randint(len(c), size=(len(c), 4))
    following = (np.arange(len(c))[:, None] + 1) % len(c)
    return np.concatenate([near, following, far], axis=1)


@dataclass
class Index:
    centroids: np.ndarray
    graph: np.ndarray
    prune: float = np.inf  # all lists
    replicate: float = REPLICATE
    longest: float = 0.0  # length of the table's longest vector

    def __post_init__(self):
        self.entries = np.unique(np.linspace(0, len(self.centroids) - 1, 32).astype(int))

    def held(self, x: np.ndarray) -> np.ndarray:
        """Candidates as they are indexed."""
        return lengthened(x, self.longest)

    def _look(self, x: np.ndarray, found: np.ndarray, row: np.ndarray, node: np.ndarray) -> None:
        """Open some nodes of the graph: measure the distance of each vector to
        those neighbours of its nodes that it has not met."""
        step = max(1, LOOKED // max(1, self.graph.shape[1]))
        for start in range(0, len(row), step):
            r, near = row[start:start + step], self.graph[node[start:start + step]]
            pair = (r[:, None] * len(self.centroids) + near).ravel()
            pair = np.unique(pair[np.isinf(found.ravel()[pair])])
            r, near = np.divmod(pair, len(self.centroids))
            gap = x[r] - self.centroids[near]
            found[r, near] = np.einsum("ij,ij->i", gap, gap)

    def walk(self, x: np.ndarray, beam: int = BEAM, prune: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each vector to the lists that a walk on the graph
        meets (infinite for others), and the distance that counts as its
        nearest.  All vectors walk at once.

        From fixed entries the walk opens the nearest nodes first, until the
        ``beam`` nearest ones met are open.  With ``prune`` it then opens every
        node within ``1 + prune`` times the nearest, until no new one is met."""
        rows = np.arange(len(x))[:, None]
        beam = min(beam, len(self.centroids))
        found = np.full((len(x), len(self.centroids)), np.inf)
        found[:, self.entries] = _squared(x, self.centroids[self.entries])
        floor = NEAR * np.sqrt(found[:, self.entries]).mean(axis=1)
        done = np.zeros(found.shape, bool)
        while True:
            best = np.argpartition(found, beam - 1, axis=1)[:, :beam]
            distance = np.where(done[rows, best], np.inf, found[rows, best])
            order = np.argsort(distance, axis=1)[:, :8]
            at, place = np.nonzero(np.isfinite(distance[rows, order]))
            if not len(at):
                break
            node = best[at, order[at, place]]
            done[at, node] = True
            self._look(x, found, at, node)
        least = np.maximum(np.sqrt(found.min(axis=1)), floor)
        least = np.where(least > 0, least, 1.0)
        while prune is not None:
            limit = ((1 + prune) * least[:, None]) ** 2
            at, node = np.nonzero(~done & np.isfinite(found) & (found <= limit))
            if not len(at):
                break
            done[at, node] = True
            self._look(x, found, at, node)
        return found, least

    def search(self, x: np.ndarray, n: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` nearest lists that a walk meets, nearest first, with their distances."""
        n = min(n, len(self.centroids))
        found, _ = self.walk(x, max(beam, n))
        rows = np.arange(len(x))[:, None]
        best = np.argpartition(found, n - 1, axis=1)[:, :n]
        best = best[rows, np.lexsort((best, found[rows, best]), axis=1)]
        return best, np.sqrt(found[rows, best])

    def lists_of(self, x: np.ndarray) -> list[list[int]]:
        """The posting lists of each vector, the nearest first."""
        lists, distance = self.search(self.held(x), 4 * COPIES)
        out = []
        for row, d in zip(lists, distance):
            mine = [int(row[0])]
            for k in range(1, len(row)):
                if len(mine) == COPIES or d[k] > (1 + self.replicate) * d[0]:
                    break
                to_chosen = ((self.centroids[mine] - self.centroids[row[k]]) ** 2).sum(1)
                if np.sqrt(to_chosen.min()) >= APART * d[k]:
                    mine.append(int(row[k]))
            out.append(mine)
        return out

    def fit_replicate(self, sample: np.ndarray) -> None:
        """Set ``replicate`` from how near the second lists of some vectors are."""
        parts = [self.search(self.held(sample[s:s + 512]), 2)[1] for s in range(0, len(sample), 512)]
        d = np.concatenate(parts)
        if d.shape[1] > 1:
            ratio = d[:, 1] / np.where(d[:, 0] > 0, d[:, 0], np.nan)
            if np.isfinite(ratio).any():
                self.replicate = float(min(REPLICATE, np.nanquantile(ratio, BOUNDARY) - 1))

    def probes_of(self, x: np.ndarray) -> list[list[int]]:
        """The lists that each query searches, the nearest first."""
        found, least = self.walk(lengthened(x, 0.0), prune=self.prune)
        order = np.argsort(found, axis=1, kind="stable")
        met = np.take_along_axis(found, order, axis=1)
        wanted = (met <= (((1 + self.prune) * least) ** 2)[:, None]) | (np.arange(order.shape[1]) < LEAST_PROBES)
        return [row[w].tolist() for row, w in zip(order, wanted & np.isfinite(met))]

    def fit_prune(self, queries: np.ndarray, neighbours: list[np.ndarray]) -> None:
        """Set ``prune`` from the true neighbours of some queries: by how much of
        its nearest list's distance the nearest list of a neighbour is farther
        from the query (a nearest list at almost no distance counts as ``NEAR``
        of the mean to the entries).  A list that the walk does not meet within
        that range is not counted as reached."""
        need = []
        x = lengthened(queries, 0.0)
        found, least = self.walk(x, prune=np.inf)
        for distance, nearest, near in zip(np.sqrt(found), least, neighbours):
            if len(near):
                reach = distance / nearest - 1
                need += [reach[lists].min() for lists in self.lists_of(near)]
        if need:
            # a little more, as products of other shapes are rounded otherwise
            self.prune = float(np.sort(need)[int(np.ceil(RECALL * len(need))) - 1]) + 1e-6


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` (array of double) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).filter(
        "id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) "
        "and exists(v, x -> x <> 0)")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (lengths[0]["n"] if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def nearest_by_scan(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """The vectors of the ``k`` best rows of each query, from a scan of all rows.
    A task keeps ``k`` rows a query."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, own = np.full((len(queries), k), -np.inf), np.zeros((len(queries), k), np.int64)
        best = np.zeros((len(queries), k, queries.shape[1]))
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                x, i = _matrix(part.column(1)), part.column(0).to_numpy()
                for q in range(len(queries)):
                    s = np.concatenate([score[q], np.where(i == ids[q], -np.inf, x @ queries[q])])
                    top = np.argpartition(-s, k - 1)[:k]
                    new, old = top[top >= k] - k, top[top < k]
                    best[q], own[q] = np.concatenate([best[q][old], x[new]]), np.concatenate([own[q][old], i[new]])
                    score[q] = np.concatenate([s[old], s[new + k]])
        q, place = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q), pa.array(score[q, place]), pa.array(own[q, place]),
             pa.array(list(best[q, place]), pa.list_(pa.float64()))], names=["q", "score", "id", "v"])

    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    found: list[list] = [[] for _ in queries]
    top = rows.select("id", "v").mapInArrow(scan, "q long, score double, id long, v array<double>")
    for r in top.withColumn("place", place).filter(F.col("place") <= k).collect():  # at most ASKED * k rows
        found[r["q"]].append(r["v"])
    return [np.array(f) for f in found]


def build(rows: DataFrame, sample: int = SAMPLE, is_query: Column | None = None, k: int = 20) -> Index | None:
    """Centroids, their graph and how far to search, from the rows of :func:`usable`."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    total, longest = rows.agg(F.count("*"), F.sqrt(F.max(square))).first()
    if not total:
        return None
    lists = int(min(MAX_LISTS, max(1, round(total / LIST))))
    hashed = F.xxhash64(F.col("id").cast("string"), F.lit(2))
    chosen = rows.withColumn("o", hashed).filter((F.col("o") / F.lit(2.0 ** 64) + 0.5) < min(1.0, 1.1 * sample / total + 1e-9))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["o", "id"], kind="stable").iloc[:sample]
        x = np.stack(pdf["v"].to_numpy())
        c = balanced_centroids(lengthened(x, longest), lists)
        index = Index(c, neighbour_graph(c), longest=longest)
        index.fit_replicate(x[:FITTED])
        return pd.DataFrame({"c": list(c), "replicate": index.replicate})

    fitted = (chosen.withColumn("one", F.lit(1)).groupBy("one")
              .applyInPandas(fit, "c array<double>, replicate double").collect())
    c = np.array([r["c"] for r in fitted])
    index = Index(c, neighbour_graph(c), replicate=fitted[0]["replicate"], longest=longest)
    asking = rows if is_query is None else rows.filter(is_query)
    asked = asking.withColumn("o", F.xxhash64(F.col("id").cast("string"), F.lit(4))).orderBy("o", "id").limit(ASKED).collect()
    if asked and len(c) > LEAST_PROBES:
        queries = np.array([r["v"] for r in asked])
        index.fit_prune(queries, nearest_by_scan(rows, np.array([r["id"] for r in asked]), queries, k))
    return index


def _assign(rows: DataFrame, index: Index, queries: bool) -> DataFrame:
    """The rows with one row per list (``list``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                x = _matrix(part.column(part.schema.get_field_index("v")))
                lists = index.probes_of(x) if queries else index.lists_of(x)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))],
                                                 names=[*part.schema.names, "lists"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, lists array<int>").withColumn("list", F.explode("lists")).drop("lists")


def tiles(posted: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows of each list in blocks (``block``) and its queries in blocks of
    their own (``part``), about ``BLOCK`` each, one copy per pair of blocks."""
    def blocks(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("list").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias(name))

    # at most MAX_LISTS rows of three numbers; a list that nobody asks has nothing to do
    sizes = F.broadcast(materialise(blocks(posted, "blocks").join(blocks(asked, "parts"), "list"), "ann-sizes"))
    held = (posted.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("list", "block", "part", "id", "v", F.lit(False).alias("asks")))
    asks = (asked.join(sizes, "list").withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("list", "block", "part", "id", "v", F.lit(True).alias("asks")))
    return held.unionByName(asks)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding", index: Index | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest rows by
    inner product that the index finds for every row with ``is_query`` (a
    condition on ``id``)."""
    rows = usable(vectors, id_col, vector_col)
    index = index or build(rows, is_query=is_query, k=k)
    if index is None:
        return (rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                            F.lit(0.0).alias("score")).limit(0))
    posted = materialise(_assign(rows, index, queries=False), "ann-postings")
    asked = materialise(_assign(rows.filter(is_query), index, queries=True), "ann-asked")

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy(bool)
        ids, queries = pdf["id"].to_numpy()[~asks], pdf["id"].to_numpy()[asks]
        out: list[tuple] = []
        if len(ids) and len(queries):
            x = np.stack(pdf["v"].to_numpy()[~asks])
            y = np.stack(pdf["v"].to_numpy()[asks])
            for start in range(0, len(y), 256):
                rough = y[start:start + 256] @ x.T
                for q, vector, row in zip(queries[start:start + 256], y[start:start + 256], rough):
                    other = np.flatnonzero(ids != q)
                    if len(other) > k:
                        least = np.partition(row[other], len(other) - k)[len(other) - k]
                        other = other[row[other] >= least - 1e-9 * (1 + abs(least))]
                    score = (x[other] * vector).sum(axis=1)
                    first = np.lexsort((ids[other], -score))[:k]
                    out.append((q, ids[other[first]], score[first]))
        return pd.DataFrame(out, columns=["query_id", "ids", "scores"]) if out else pd.DataFrame(
            {"query_id": pd.Series(dtype="int64"), "ids": pd.Series(dtype=object), "scores": pd.Series(dtype=object)})

    # one row per query and block of rows, at most k rows of the block in it
    found = tiles(posted, asked).groupBy("list", "block", "part").applyInPandas(
        best, "query_id long, ids array<long>, scores array<double>")
    # a replicated row is found in several lists, with the same score; sorted, its copies are neighbours
    merged = found.groupBy("query_id").agg(F.flatten(F.collect_list(F.arrays_zip("scores", "ids"))).alias("all"))
    merged = merged.withColumn("all", F.expr("array_sort(transform(all, x -> named_struct('less', -x.scores, 'id', x.ids)))"))
    nearest = merged.select("query_id", F.posexplode(F.expr(
        f"slice(filter(all, (x, i) -> i = 0 or x <> all[i - 1]), 1, {k})")).alias("place", "x"))
    return nearest.select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.id").alias("vec_id"),
                          (-F.col("x.less")).alias("score"))
