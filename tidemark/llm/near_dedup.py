"""Operator 3, MinHash near-dedup: b-bit MinHash, bands, exact confirmation.

A text's set holds its distinct shingles of five words (ASCII lower case; with
fewer words the whole sequence is one shingle).  Texts are linked when their
sets have a similarity of 0.75 or more.

1. One pass over the texts gives each row the size of its set, a 128-bit hash
   of the set, 128 minima of which the low 4 bits are kept (a packed signature
   of 64 bytes), and the keys of 32 bands of 4 minima.  A pair at 0.75 shares a
   band with a probability of 1 - (1 - 0.75^4)^32 > 0.99999.
2. Rows with the same set are one node from here on; copies are never paired.
3. In each band bucket the smallest node is the hub, and every other node is
   its candidate: as many pairs as rows, however large the bucket.  The
   similarity of a candidate pair is estimated by counting equal 4-bit lanes
   with bit counts, corrected for chance collisions (1/16).  Pairs well below
   the threshold (over 4 standard deviations) end here; the others are confirmed
   on the full sets.
4. Confirmed links give components.  What may still be missing is a link
   between two components that meet in a bucket without their hubs being alike.
   For such buckets every node outside the bucket's main component (an asking
   node) is compared with all nodes of other components, in tiles of at most
   ``BLOCK`` by ``BLOCK`` nodes spread over tasks: first by signatures, which
   leaves the nodes that have a pair to confirm, then, with the sets of these
   alone, exactly.  Pairs stay inside the task; what leaves it is at most a
   spanning forest of the links found.  A pair that meets in several buckets is
   looked at in the first of its bands.  Then the components are worked out again.

No bucket, group or list of partners is capped.  Sets are made again from the
texts of the nodes that have a candidate, so only those texts' sets are shuffled.

Edge cases: null, empty and white texts have an empty set and are linked with
nothing (their component is their own id); rows with null ids are linked like
others, and an id counts as the smallest of a component only if it is not null;
rows with equal ids are rows of their own with the same answer as to ``kept``;
an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Known, id_and_text, materialise, numbered, slices
from tidemark.llm.components import connected_components

WORDS = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BITS = 4
LANES = 64 // BITS
LONGS = HASHES // LANES
WORD_CACHE = 300_000
#: nodes on either side of a tile of a bucket in the second round
BLOCK = 1024
#: the estimate at which a pair is still confirmed (0.75 less over four standard deviations of 0.04)
ESTIMATE = 0.58
_LOW = 0x1111111111111111

_seed = np.random.RandomState(20240501)
_MUL = _seed.randint(0, 1 << 62, HASHES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _seed.randint(0, 1 << 62, HASHES, dtype=np.int64).astype(np.uint64)
_BAND = _seed.randint(0, 1 << 62, BANDS, dtype=np.int64).astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes() -> Known:
    return Known(xxhash.xxh3_64_intdigest, WORD_CACHE)


def shingles(text: str, known: Known) -> np.ndarray:
    """The text's set as sorted 64-bit hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    x = np.zeros(len(words) - WORDS + 1, np.uint64)
    for j in range(WORDS):
        x = x * np.uint64(0x9E3779B97F4A7C15) + h[j:len(words) - WORDS + 1 + j]
    return np.unique(_mix(x))


def minima(items: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(items), 1024):
        least = np.minimum(least, (items[start:start + 1024, None] * _MUL + _ADD).min(axis=0))
    return least >> np.uint64(32)


def signature(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, packed into 64-bit words."""
    lanes = (least & np.uint64((1 << BITS) - 1)).reshape(LONGS, LANES)
    return np.bitwise_or.reduce(lanes << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)), axis=1).view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    key = _BAND.copy()
    for column in least.reshape(BANDS, ROWS).T:
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``id``, ``n``, ``node`` (hash of the set), ``sig`` and ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        for batch in slices(batches):
            n, node, sig, bands = [], [], [], []
            for text in batch.column(1).to_pylist():
                items = shingles(text, known)
                n.append(len(items))
                if len(items):
                    least = minima(items)
                    node.append(xxhash.xxh3_128_digest(items.tobytes()))
                    sig.append(signature(least))
                    bands.append(band_keys(least))
                else:
                    node.append(None)
                    sig.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()),
                 pa.array(sig, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "n", "node", "sig", "bands"])

    texts = id_and_text(docs, id_col, text_col)
    key = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {key}, n long, node binary, sig array<long>, bands array<long>")


def estimated(a: str, b: str) -> Column:
    """Similarity by equal lanes of two signatures, corrected for lanes equal by chance."""
    different = F.lit(0)
    for i in range(LONGS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        folded = x
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, k))
        different = different + F.bit_count(folded.bitwiseAND(F.lit(_LOW)))
    equal, chance = 1 - different / F.lit(float(HASHES)), 2.0 ** -BITS
    return (equal - chance) / (1 - chance)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for each row of ``a`` with each row of ``b``."""
    different = np.zeros((len(a), len(b)), np.int64)
    for i in range(LONGS):
        x = a[:, i].view(np.uint64)[:, None] ^ b[:, i].view(np.uint64)[None, :]
        folded = x.copy()
        for k in range(1, BITS):
            folded |= x >> np.uint64(k)
        different += np.bitwise_count(folded & np.uint64(_LOW))
    chance = 2.0 ** -BITS
    return (1 - different / HASHES - chance) / (1 - chance)


def sets_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node`` and ``items`` (the sorted set) of ``nodes`` (``node``, ``id`` of one of its rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        for batch in slices(batches):
            node, items = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingles(text, known).tobytes()
                if xxhash.xxh3_128_digest(found) == key:  # another row may have the same id
                    node.append(key)
                    items.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(items, pa.binary())],
                                             names=["node", "items"])

    texts = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("id"))
    wanted = nodes.select("node", F.xxhash64("id").alias("key"), F.col("id").alias("wid")).hint("shuffle_hash")
    rows = texts.join(wanted, "key").filter(F.col("id").eqNullSafe(F.col("wid"))).select("node", "text")
    return rows.mapInArrow(run, "node binary, items binary").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` with whether their full sets are alike enough (``linked``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])

    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b")
    with_a = with_b.join(sets.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a")
    return with_a.select("a", "b", "items_a", "items_b").mapInArrow(run, "a binary, b binary, linked boolean")


def _tiles(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame, np.ndarray, np.ndarray]]:
    """For each tile of a cell the asking rows, the asked rows, and the places in
    them of the pairs to confirm."""
    for (_, band, _, _), tile in pdf.groupby(["bucket", "band", "q", "t"], sort=False):
        asks = tile["asks"].to_numpy(bool)
        asking, asked = tile[asks], tile[~asks]
        if not len(asking) or not len(asked):
            continue
        passing = estimates(np.stack(asking["sig"].to_numpy()), np.stack(asked["sig"].to_numpy())) >= ESTIMATE
        passing &= asking["label"].to_numpy()[:, None] != asked["label"].to_numpy()[None, :]
        i, j = np.nonzero(passing)
        if len(i) and band:  # pairs that share an earlier band are looked at there
            bands_i, bands_j = np.stack(asking["bands"].to_numpy()), np.stack(asked["bands"].to_numpy())
            new = np.ones(len(i), bool)
            for k in range(band):
                new &= bands_i[i, k] != bands_j[j, k]
            i, j = i[new], j[new]
        if len(i):
            yield asking, asked, i, j


_PLACES = ["bucket", "band", "q", "t", "node", "label", "asks", "cell"]


def _nodes_with_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    found = [part for asking, asked, i, j in _tiles(pdf)
             for part in (asking.iloc[np.unique(i)], asked.iloc[np.unique(j)])]
    return pd.concat(found)[_PLACES] if found else pdf.iloc[:0][_PLACES]


def _links_of(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        parent: dict = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for asking, asked, i, j in _tiles(pdf):
            sets = [np.frombuffer(x, np.uint64) for x in asked["items"]]
            label_i, label_j = asking["label"].to_numpy(), asked["label"].to_numpy()
            name_i, name_j = asking["node"].to_numpy(), asked["node"].to_numpy()
            own = asking["items"].to_numpy()
            for at in np.unique(i):
                mine = np.frombuffer(own[at], np.uint64)
                others = j[i == at]
                sizes = np.array([len(sets[k]) for k in others])
                joined = np.concatenate([sets[k] for k in others])
                place = np.minimum(np.searchsorted(mine, joined), len(mine) - 1)
                shared = np.add.reduceat((mine[place] == joined).astype(np.int64), np.cumsum(sizes) - sizes)
                for k in others[100 * shared >= percent * (len(mine) + sizes - shared)]:
                    x, y = root(label_i[at]), root(label_j[k])
                    if x != y:  # not linked yet by what this task has found
                        parent[x] = y
                        a.append(name_i[at])
                        b.append(name_j[k])
        return pd.DataFrame({"a": a, "b": b}, dtype=object)

    return run


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id`` (the
    smallest id of the rows linked with it, directly or not) and ``kept``."""
    rows = materialise(fingerprints(docs, id_col, text_col), "near-rows")
    nodes = materialise(rows.filter("node is not null").groupBy("node").agg(
        F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "near-nodes")
    members = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    hubs = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("size")).filter("size > 1")
    shared = materialise(members.join(hubs.select("bucket", "hub"), "bucket"), "near-buckets")
    sig = nodes.select("node", "sig")

    def passing(pairs: DataFrame) -> DataFrame:
        with_b = pairs.join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
        with_a = with_b.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
        return with_a.filter(estimated("sig_a", "sig_b") >= ESTIMATE).select("a", "b")

    first = materialise(passing(shared.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
                                .distinct()), "near-pairs")
    # every node with a partner that the estimate passes may meet others in the second round
    wanted = nodes.select("node", "id").join(shared.select("node").distinct(), "node", "left_semi")
    sets = materialise(sets_of(docs, wanted, id_col, text_col), "near-sets")
    checked = materialise(confirmed(first, sets, percent), "near-checked")
    links = checked.filter("linked").select("a", "b")
    labels = connected_components(links)

    # buckets in which several components meet: the nodes outside the main one ask all others
    placed = shared.join(labels, "node", "left").select(
        "bucket", "band", "node", F.coalesce("label", "node").alias("label"))
    parts = placed.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = (parts.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("size"),
                                         F.count("*").alias("parts"))
             .filter("parts > 1").select("bucket", F.col("main.label").alias("main"),
                                         F.ceil(F.col("size") / BLOCK).cast("int").alias("across"),
                                         F.ceil((F.col("size") - F.col("main.n")) / BLOCK).cast("int").alias("down")))
    met = (placed.join(mixed, "bucket")
           .withColumn("t", F.pmod(F.xxhash64("node"), F.col("across")).cast("int"))
           .withColumn("q", F.pmod(F.xxhash64("node", F.lit(1)), F.col("down")).cast("int")))
    asked = met.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("down") - 1))).withColumn("asks", F.lit(False))
    asking = (met.filter("label <> main")
              .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("across") - 1))).withColumn("asks", F.lit(True)))
    places = ["bucket", "band", "q", "t", "node", "label", "asks"]
    # tiles of large buckets are cells of their own, small buckets share cells
    cells = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = (asked.unionByName(asking)
             .withColumn("cell", F.when(F.col("across") > 1, F.xxhash64("bucket", "q", "t"))
                         .otherwise(F.pmod(F.xxhash64("bucket"), F.lit(cells)))).select(*places, "cell"))
    marks = nodes.select("node", "sig", "bands")
    alike = (tiles.join(marks, "node").groupBy("cell")
             .applyInPandas(_nodes_with_pairs, "bucket long, band int, q int, t int, node binary, label binary, "
                                               "asks boolean, cell long"))
    exact = (materialise(alike, "near-alike").join(marks, "node").join(sets, "node").groupBy("cell")
             .applyInPandas(_links_of(percent), "a binary, b binary"))
    more = materialise(exact.distinct(), "near-more")
    if more.limit(1).count():
        labels = connected_components(links.unionByName(more))

    named = nodes.select("node", "id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_node = named.join(smallest, "label").select("node", "component_id")
    full = rows.filter("node is not null").join(of_node, "node").select("id", "n", "component_id")
    empty = rows.filter("node is null").select("id", "n", F.col("id").alias("component_id"))
    return full.unionByName(empty).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of linked rows one,
    that with the smallest id (null ids last; of equal ids the first one read)."""
    rows, rid = numbered(docs, "near-numbered")
    key = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("own"), F.col(rid).alias("rid"))
    keyed = rows.select(key.alias("key"), F.col(f"`{text_col}`").alias("text"))
    dropped = near_dedup(keyed, "key", "text", percent).filter("not kept").select(F.col("key.rid").alias(rid))
    return rows.join(dropped, rid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
