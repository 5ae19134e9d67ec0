"""Operator 12, prefix trie of conversations by whole-sequence collapse.

Every distinct sequence of first turns is a node.  The trie is never built turn
by turn: identical conversations collapse into one weighted sequence with the list
of conversations that end there, sequences that are proper prefixes of others are
dropped by an anti-join (what stays are the leaves), and the nodes are weighted
aggregates over the prefixes of the distinct sequences.

* A turn is known by the MD5 of role and text and its number of words; whole texts
  are read once and never shuffled.
* A prefix is known by 128 bits, the exclusive or over its turns of two hashes of
  depth and turn.  Prefixes of all conversations come from running totals over range
  partitions (:func:`tidemark.operators.order.running`), as do the numbers of turns,
  so a conversation that holds a third of all rows is spread over tasks.
* ``saved_tokens`` sums (members - 1) * words over a subtree.  A node is owned by the
  sequence of its smallest member; along a sequence the owned nodes are the deepest
  ones.  Each sequence's owned values are summed from its end upwards, and a node
  adds what the sequences through it have below it: one row per sequence and depth,
  never one per pair of node and ancestor.
* The digest of a list of ends is one stream of bytes.  The sorted ids are joined to
  texts of up to ``CHUNK`` ids in range partitions, and one task per list feeds those to
  the hash, a text at a time: memory is bounded by a text, the rows of that task are
  ``CHUNK`` times fewer.

Edge cases: null roles and texts are empty; turns go by turn number, nulls first,
and rows that repeat a number by the MD5 of role and text (repeated rows are turns of
their own); rows with a null conversation id take no part; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.llm.mixing import words_of
from tidemark.operators.order import running

CHUNK = 4096


def ordered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``conv``, ``depth`` (from 1), ``turn_md5`` and ``words`` of every turn."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), digest.alias("turn_md5"),
        words_of(text).alias("words"))
    placed = running(turns, ["conv", F.col("turn").asc_nulls_first(), "turn_md5"], name="llm-trie-turns")
    first = placed.groupBy("conv").agg(F.min("at").alias("first"))
    return placed.join(first, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("depth"), "turn_md5", "words")


def splice(turns: DataFrame, base: Column, heads: Column, longest: int) -> DataFrame:
    """The turns of conversations whose first ``heads`` turns (at most
    ``longest``, columns over ``conv``) are those of conversation ``base``: all
    it has if it has fewer, none if it is absent; their own first ``heads`` turns
    go."""
    sizes = turns.groupBy("conv").agg(F.max("depth").alias("n"))
    known = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    wanted = materialise(sizes.select("conv", base.alias("base"), heads.cast("long").alias("h")).join(known, "base", "left")
                         .withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))), "trie-wanted")
    head = turns.filter(F.col("depth") <= longest).withColumnRenamed("conv", "base")
    borrowed = wanted.join(head, "base").filter(F.col("depth") <= F.col("k")).select("conv", "depth", "turn_md5", "words")
    own = (turns.join(wanted.select("conv", "h", "k"), "conv").filter(F.col("depth") > F.col("h"))
           .select("conv", (F.col("depth") - F.col("h") + F.col("k")).alias("depth"), "turn_md5", "words"))
    return borrowed.unionByName(own)


def _ends(ending: DataFrame) -> DataFrame:
    """``s1``, ``s2`` and the digest of the sorted ids (``conv``) that end there."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out, k = None, [], [], 0

        def flush():
            if ids:
                out.append((*key, k, ",".join(map(str, ids))))

        for batch in batches:
            for *new, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if new != key or len(ids) == CHUNK:
                    flush()
                    key, ids, k = new, [], k + 1
                ids.append(conv)
            if len(out) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["s1", "s2", "k", "text"])
                out.clear()
        flush()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["s1", "s2", "k", "text"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for *new, text in zip(*(batch.column(c).to_pylist() for c in ("s1", "s2", "text"))):
                if new != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = new, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["s1", "s2", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())],
                                             names=["s1", "s2", "ends_sha256"])

    parts = int(ending.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["s1", "s2", "conv"]
    texts = materialise(ending.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*order)
                        .mapInArrow(joined, "s1 long, s2 long, k long, text string")
                        .withColumn("part", F.spark_partition_id()), "trie-ends")
    return (texts.repartition(parts, "s1", "s2").sortWithinPartitions("s1", "s2", "part", "k")
            .select("s1", "s2", "text").mapInArrow(hashed, "s1 long, s2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (``conv``, ``depth`` from 1 without
    gaps, ``turn_md5``, ``words``); ``conversations`` (``conv``) names all members,
    also those without turns.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    zero = F.lit(0).cast("long")
    hashed = turns.select("conv", "depth", "words", F.xxhash64(F.lit(1), "depth", "turn_md5").alias("x1"),
                          F.xxhash64(F.lit(2), "depth", "turn_md5").alias("x2"))
    chained = running(hashed, ["conv", "depth"], xors={"b1": "x1", "b2": "x2"}, name="llm-trie-chain")
    first = chained.filter("depth = 1").select("conv", F.col("b1").alias("f1"), F.col("b2").alias("f2"))
    paths = materialise(chained.join(first, "conv").select(
        "conv", "depth", "words", F.expr("b1 ^ f1").alias("p1"), F.expr("b2 ^ f2").alias("p2"),
        F.expr("b1 ^ f1 ^ x1").alias("n1"), F.expr("b2 ^ f2 ^ x2").alias("n2")), "trie-paths")

    # whole sequences: identical conversations collapse, with their number and their smallest id
    last = paths.groupBy("conv").agg(F.max(F.struct("depth", "n1", "n2")).alias("e"))
    ending = materialise(conversations.select("conv").distinct().join(last, "conv", "left").select(
        "conv", F.coalesce("e.depth", zero).alias("length"), F.coalesce("e.n1", zero).alias("s1"),
        F.coalesce("e.n2", zero).alias("s2")), "trie-ending")
    sequences = ending.groupBy("s1", "s2").agg(F.count("*").alias("weight"), F.min("conv").alias("conv"),
                                               F.min("length").alias("length"))
    sequences = materialise(sequences, "trie-sequences")
    steps = paths.join(sequences.select("conv", "weight", "length", "s1", "s2"), "conv")
    # a sequence that is the parent of a step is a proper prefix; the others are the leaves
    proper = steps.select(F.col("p1").alias("s1"), F.col("p2").alias("s2")).distinct()
    leaves = sequences.join(proper, ["s1", "s2"], "left_anti").select("conv", F.lit(1).alias("leaf"))
    told = sequences.join(leaves, "conv", "left").select("conv", "weight", "length", F.coalesce("leaf", F.lit(0)).alias("leaf"))
    roots = told.select("conv", zero.alias("depth"), zero.alias("words"), F.lit(None).cast("long").alias("p1"),
                        F.lit(None).cast("long").alias("p2"), zero.alias("n1"), zero.alias("n2"), "weight", "length", "leaf")
    steps = materialise(paths.join(told, "conv").unionByName(roots), "trie-steps")

    nodes = materialise(steps.groupBy("n1", "n2").agg(
        F.sum("weight").alias("n_convs"), F.min("conv").alias("conv_id"), F.sum("leaf").alias("n_leaves"),
        F.min("depth").alias("depth"), F.min("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2")),
        "trie-nodes")
    worth = (steps.join(nodes.select("n1", "n2", "conv_id", ((F.col("n_convs") - 1) * F.col("words")).alias("worth")), ["n1", "n2"])
             .select("conv", "depth", "length", "n1", "n2",
                     F.when(F.col("conv") == F.col("conv_id"), F.col("worth")).otherwise(zero).alias("worth")))
    summed = running(worth, ["conv", "depth"], sums={"above": "worth"}, name="llm-trie-worth")
    whole = summed.filter("depth = length").select("conv", (F.col("above") + F.col("worth")).alias("whole"))
    below = summed.join(whole, "conv").select("n1", "n2", (F.col("whole") - F.col("above")).alias("saved"), zero.alias("child"))
    child = nodes.filter("depth > 0").select(F.col("p1").alias("n1"), F.col("p2").alias("n2"), zero.alias("saved"),
                                             F.lit(1).cast("long").alias("child"))
    totals = below.unionByName(child).groupBy("n1", "n2").agg(F.sum("saved").alias("saved_tokens"),
                                                               F.sum("child").alias("n_children"))
    ends = _ends(ending).select(F.col("s1").alias("n1"), F.col("s2").alias("n2"), "ends_sha256")
    parents = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (nodes.join(totals, ["n1", "n2"]).join(ends, ["n1", "n2"], "left").join(parents, ["p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("n_leaves").cast("long").alias("n_leaves"),
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))
