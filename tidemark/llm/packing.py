"""Operator 10, best-fit packing: bounded-space online best-fit.

``tokenise`` turns texts into pieces of at most ``capacity`` token ids;
``pack`` places pieces in sequences.  Each task packs its own rows: it keeps at
most ``open_bins`` open bins, found by a bitset keyed by free space (bit f is
set while some open bin has f free tokens).  A piece goes to the fullest bin
that can take it, the lowest set bit at or above its length; if none can, it
opens a bin, and when the number of open bins is used up the fullest closes.

Rows are looked at in windows of ``window`` pieces, the longest first, which
packs better than their order in the table.  Memory is bounded by the window
and the open bins whatever the partition holds; what packing by partition
costs is at most the last bins of each task.  Tasks share nothing, and a
repeated task gives the same sequences: ``sequence_id`` holds the partition
number above bit 33 and a running number below.

Edge cases: a null or empty text is its end token alone; a text longer than the
capacity is cut into full pieces and a rest; rows with null or repeated ids are
packed as rows of their own; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.bpe import byte_alphabet
from tidemark.llm.chunks import words
from tidemark.llm.common import Known, id_and_text, slices

CAPACITY = 2048
OPEN_BINS = 4096
WINDOW = 16384
CACHE = 400_000

PIECES = "piece int, start long, length long, ids_crc32 long"


class BestFit:
    """The open bins of one task."""

    def __init__(self, capacity: int, open_bins: int, first_id: int):
        self.capacity, self.limit, self.next_id = capacity, open_bins, first_id
        self.free = 0  # bit f: some open bin has f free tokens
        self.by_free: dict[int, list[int]] = {}
        self.opened = 0

    def _put(self, free: int, bin_id: int) -> None:
        if free:
            self.by_free.setdefault(free, []).append(bin_id)
            self.free |= 1 << free
            self.opened += 1

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        bin_id = held.pop()
        if not held:
            del self.by_free[free]
            self.free &= ~(1 << free)
        self.opened -= 1
        return bin_id

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it for a piece of ``length`` tokens."""
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece has 1 to {self.capacity} tokens, not {length}")
        fits = self.free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            if self.opened >= self.limit:  # the fullest closes
                self._take((self.free & -self.free).bit_length() - 1)
            free, bin_id = self.capacity, self.next_id
            self.next_id += 1
        self._put(free - length, bin_id)
        return bin_id, self.capacity - free


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# white space, printable ASCII and the letters of Latin-1: composed already, and
# told apart from numbers and symbols without the library
_PLAIN = re.compile("[\t-\r !-~À-ÖØ-öø-ÿ]*")
_PARTS = re.compile("[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^a-zß-öø-ÿ0-9\\s]+")


def word_encoder(path: str, cache_limit: int = CACHE):
    """``encode(text)``: the ids of a text as int32 bytes.

    In plain texts every part between the cuts of the vocabulary's own pattern
    is merged by the library's model, each different one once while the cache
    lasts.  White space ends words and is dropped, so other texts, and those
    with what may be a special token, go through the whole of the library's
    pipeline by the runs between white space.
    """
    tokenizer = _tokenizer(path)
    merge, byte_chars = tokenizer.model.tokenize, byte_alphabet()

    def part_ids(part: str) -> bytes:
        mapped = part if part.isascii() else "".join([byte_chars[b] for b in part.encode()])
        return array("i", [t.id for t in merge(mapped)]).tobytes()

    def run_ids(run: str) -> bytes:
        return array("i", tokenizer.encode(run, add_special_tokens=False).ids).tobytes()

    parts, runs = Known(part_ids, cache_limit), Known(run_ids, cache_limit // 4)

    def encode(text: str) -> bytes:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(parts.__getitem__, _PARTS.findall(text.lower())))
        return b"".join(map(runs.__getitem__, words(text)))

    return encode


def _tokeniser(tokenizer_path: str, capacity: int, end_id: int, with_ids: bool):
    """A function from batches of (id, text) to batches of pieces; ids keep their type."""
    end = np.array([end_id], dtype="<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(tokenizer_path)
        for batch in slices(batches):
            rows: list[tuple] = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((row, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            row, piece, start, length, crc, parts = zip(*rows)
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                flat = pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))
                offsets = pa.array(np.concatenate([[0], np.cumsum(length)]).astype("int32"))
                columns.append(pa.ListArray.from_arrays(offsets, flat))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _packer(capacity: int, open_bins: int, window: int, length_col: str):
    """A function that adds ``sequence_id`` and ``offset`` to batches of pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        bins = BestFit(capacity, open_bins, (context.partitionId() if context else 0) << 33)
        held: list[pa.RecordBatch] = []

        def placed() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            lengths = rows.column(rows.schema.get_field_index(length_col)).to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(lengths), "int64"), np.empty(len(lengths), "int64")
            for i in np.argsort(-lengths, kind="stable").tolist():
                sequence[i], offset[i] = bins.place(int(lengths[i]))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sequence), pa.array(offset)],
                                             names=[*rows.schema.names, "sequence_id", "offset"])

        for batch in batches:
            for start in range(0, batch.num_rows, window):
                part = batch.slice(start, window)
                if held and sum(b.num_rows for b in held) + part.num_rows > window:
                    yield from placed()
                held.append(part)
        if held:
            yield from placed()

    return run


def _pieces(docs: DataFrame, with_ids: bool) -> str:
    """The columns of pieces, ids of the documents' type."""
    return f"id {docs.schema['id'].dataType.simpleString()}, {PIECES}" + (", ids array<int>" if with_ids else "")


def tokenise(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of the texts' ids (each text ends with ``end_id``): ``id``,
    ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    texts = id_and_text(docs, id_col, text_col)
    return texts.mapInArrow(_tokeniser(tokenizer_path, capacity, end_id, with_ids), _pieces(texts, with_ids))


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, window: int = WINDOW,
         length_col: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows that have a length of 1 to ``capacity``."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields]
    return pieces.mapInArrow(_packer(capacity, open_bins, window, length_col),
                             ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack: one row per piece.  Both run in one Python process a
    task: two steps of their own would keep two."""
    texts = id_and_text(docs, id_col, text_col)
    cut, place = _tokeniser(tokenizer_path, capacity, 0, with_ids), _packer(capacity, open_bins, WINDOW, "length")
    packed = texts.mapInArrow(lambda batches: place(cut(batches)), _pieces(texts, with_ids) + ", sequence_id long, offset long")
    return packed.withColumnRenamed("id", id_col)
