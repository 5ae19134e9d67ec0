"""Operator 7, chat formatting as a prefix tree.

Conversations that share their first turns share the nodes of a forest; every
node's tokens are emitted once, in depth-first order, at an address (``start``)
in one running sequence.  A conversation is the list of its ancestors' address
intervals, each with its first position id: a token attends to the intervals of
its own path only, and position ids count along the path.

* A turn's node is a 128-bit running hash (an exclusive or over the turns so
  far of hashes of place, role and text), so equal prefixes meet by equality.
* Depth-first order is the order of (rank of the first path through a node,
  depth), where distinct paths are ranked by a range-partitioned sort.  Addresses
  are running sums inside the sorted partitions plus one sum per partition: a
  first turn shared by a third of all conversations is spread over tasks.
* The template writes a user turn as ``<s>[INST] text [/INST]``, an assistant
  turn as ``text</s>``, a system turn as ``<s>[INST] <<SYS>>text<</SYS>> [/INST]``
  and any other as ``<s>[INST] <<ROLE>>role<</ROLE>>text [/INST]``.  In texts and
  roles a backslash is doubled and a backslash is set into each control string
  after its first character, which :func:`unescape` takes back.
* Positions are running sums along a path, and the tokens are read back in sorted
  order, a turn at a time: work is linear in the turns of a conversation.
* Marks and text are tokenised apart, so the loss mask (assistant texts) falls
  on whole tokens.

Edge cases: null texts and null roles are empty; turns are taken by turn number
(nulls first), repeated numbers by role and text, and repeated rows are turns of
their own; rows with a null conversation id form one conversation with that id;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.bpe import Encoder, vocabulary
from tidemark.llm.common import materialise, slices

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_TURN = re.compile(r"<s>\[INST\] (?:<<SYS>>(?P<system>.*?)<</SYS>>|<<ROLE>>(?P<role>.*?)<</ROLE>>(?P<other>.*?)|(?P<user>.*?))"
                   r" \[/INST\]|(?P<assistant>.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def marked(role: str, text: str) -> tuple[str, str, str]:
    """What stands before a turn's text, the escaped text, and what stands after it."""
    if role == "user":
        return "<s>[INST] ", escape(text), " [/INST]"
    if role == "assistant":
        return "", escape(text), "</s>"
    if role == "system":
        return "<s>[INST] <<SYS>>", escape(text), "<</SYS>> [/INST]"
    return f"<s>[INST] <<ROLE>>{escape(role)}<</ROLE>>", escape(text), " [/INST]"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"not a formatted conversation at {at}")
        if m["role"] is not None:
            turns.append((unescape(m["role"]), unescape(m["other"])))
        else:
            role = next(r for r in ("system", "user", "assistant") if m[r] is not None)
            turns.append((role, unescape(m[role])))
        at = m.end()
    return turns


class Forest(NamedTuple):
    #: node, depth, start, position, ids, loss_start, loss_stop (tokens of the node under the loss mask)
    nodes: DataFrame
    #: leaf, intervals (start, stop, position) of the path from the root
    paths: DataFrame
    #: conversation id and leaf
    conversations: DataFrame


def _tokenised(nodes: DataFrame, vocab_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocab_path)
        for batch in slices(batches):
            roles, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            parts = [p for role, text in zip(roles, texts) for p in marked(role, text)]
            ids = [np.frombuffer(b, "<i4") for b in encoder(parts)]
            whole = [np.concatenate(ids[k:k + 3]) for k in range(0, len(ids), 3)]
            spoken = [role == "assistant" for role in roles]
            first = [len(ids[3 * k]) if s else 0 for k, s in enumerate(spoken)]
            last = [len(ids[3 * k]) + len(ids[3 * k + 1]) if s else 0 for k, s in enumerate(spoken)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(whole, pa.list_(pa.int32())), pa.array([len(w) for w in whole], pa.int64()),
                 pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                names=["node", "ids", "n", "loss_start", "loss_stop"])

    return nodes.mapInArrow(run, "node string, ids array<int>, n long, loss_start int, loss_stop int")


def _addresses(nodes: DataFrame) -> DataFrame:
    """``node`` and ``start``: running sums of ``n`` in the order of (rank, depth)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            local = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(local), pa.array(np.full(len(n), part, "int32"))],
                names=["node", "n", "local", "part"])

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    summed = materialise(nodes.repartitionByRange(parts, "rank", "depth").sortWithinPartitions("rank", "depth")
                         .select("node", "n").mapInArrow(run, "node string, n long, local long, part int"), "chat-order")
    base, bases = 0, []
    for r in sorted(summed.groupBy("part").agg(F.sum("n").alias("n")).collect()):  # one row per partition
        bases.append((r["part"], base))
        base += r["n"]
    if not bases:
        return summed.select("node", F.col("local").alias("start"))
    bases = F.broadcast(nodes.sparkSession.createDataFrame(bases, "part int, base long"))
    return summed.join(bases, "part").select("node", (F.col("base") + F.col("local")).alias("start"))


def build_forest(conversations: DataFrame, vocab_path: str, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> Forest:
    order = W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = (conversations.select(F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                                  F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
                                  F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
             .withColumn("depth", F.row_number().over(order)))
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    running = [F.bit_xor(F.xxhash64(F.lit(seed), "depth", "role", "text")).over(so_far) for seed in (7, 77)]
    turns = materialise(turns.withColumn("node", F.format_string("%016x%016x", *running)), "chat-turns")

    tokens = materialise(_tokenised(turns.groupBy("node").agg(F.first("role").alias("role"), F.first("text").alias("text")),
                                    vocab_path), "chat-tokens")
    convs = materialise(turns.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("path"))
                        .select("conv", F.element_at("path.node", -1).alias("leaf"), F.col("path.node").alias("path")),
                        "chat-conversations")
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = materialise(convs.groupBy("leaf").agg(F.first("path").alias("path"))
                         .repartitionByRange(parts, "path").sortWithinPartitions("path")
                         .withColumn("rank", F.monotonically_increasing_id()), "chat-paths")
    on_path = ranked.select("leaf", "rank", F.posexplode("path").alias("depth", "node"))
    first = on_path.groupBy("node").agg(F.min("rank").alias("rank"), F.min("depth").alias("depth"))
    placed = materialise(first.join(tokens.select("node", "n"), "node"), "chat-first")
    starts = materialise(_addresses(placed).join(placed.select("node", "n", "depth"), "node"), "chat-starts")
    before = W.partitionBy("leaf").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    steps = materialise(on_path.select("leaf", "depth", "node").join(starts.select("node", "start", "n"), "node").select(
        "leaf", "node", "start", (F.col("start") + F.col("n")).alias("stop"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("position")), "chat-steps")
    positions = steps.groupBy("node").agg(F.min("position").alias("position"))
    nodes = (tokens.join(starts.select("node", "start", "depth"), "node").join(positions, "node")
             .select("node", "depth", "start", "position", "ids", "loss_start", "loss_stop"))
    # addresses grow along a path, so this is the order of the turns
    paths = steps.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "position"))).alias("intervals"))
    return Forest(nodes, materialise(paths, "chat-intervals"),
                  convs.select(F.col("conv").alias(id_col), "leaf"))


class _Told:
    """What the emitted tokens of one conversation say, a turn at a time."""

    def __init__(self, token: list[bytes]):
        self.token, self.n_turns, self.loss_chars, self.formatted_chars = token, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: list[int], loss_start: int, loss_stop: int) -> None:
        pieces = [self.token[i] for i in ids]
        formatted = b"".join(pieces).decode()
        for role, text in parse(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        masked = unescape(b"".join(pieces[loss_start:loss_stop]).decode())
        self.loss.update(masked.encode())
        self.loss_chars += len(masked)
        self.formatted_chars += len(formatted)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(forest: Forest, vocab_path: str) -> DataFrame:
    """``leaf`` with the turns, the loss text and the formatted text that the
    emitted tokens hold: the intervals of a path are read at their addresses, in
    order.  A task holds one turn and two hash states, however long a
    conversation is."""
    schema = "leaf string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = vocabulary(vocab_path).token_bytes
        leaf, told = None, None
        for batch in slices(batches):
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("leaf", "ids", "loss_start", "loss_stop"))
            for new, ids, loss_start, loss_stop in zip(*columns):
                if new != leaf:
                    if told is not None:
                        out.append((leaf, *told.row()))
                    leaf, told = new, _Told(token)
                told.add(ids, loss_start, loss_stop)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
        if told is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (leaf, *told.row())], names=names)

    parts = int(forest.nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = forest.paths.select("leaf", F.explode("intervals").alias("i")).select("leaf", "i.start", "i.position")
    return (read.join(forest.nodes.select("start", "ids", "loss_start", "loss_stop"), "start")
            .repartition(parts, "leaf").sortWithinPartitions("leaf", "position")
            .select("leaf", "ids", "loss_start", "loss_stop").mapInArrow(run, schema))


def digests(forest: Forest, vocab_path: str) -> DataFrame:
    """One row per conversation with what was read back for its leaf."""
    return forest.conversations.join(read_back(forest, vocab_path), "leaf").drop("leaf")
