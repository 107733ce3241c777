"""Harmonic packing of token ids into sequences of at most ``CAPACITY`` tokens.

A document's ids are cut into whole sequences and a rest. A rest of length in (C/(k+1), C/k] belongs to class 1/k, whose bins
take exactly k rests, so a bin closes without looking at any other: every task fills its own bins, nothing is shuffled. What a
closed bin has left is a gap. A rest that fits into a gap goes there whole; only when more than ``WAITING`` closed bins wait is
one cut, to fill a gap exactly. A bin whose gap is smaller than ``LEAST`` leaves with that padding. At the end of a task what
its open bins hold fills the gaps that are left and then sequences of its own; what is short of one makes sequences of a
power of two, which are not padded.

Sequence ids are partition * 2^33 + a count: a task that runs again gives the same rows.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.tokens import blocks

CAPACITY = 2048
END = 1  # the id after every document
WAITING = 64  # closed bins of a task that may wait for a rest that fits their gap
LEAST = 17  # tokens of the smallest piece that is cut; a smaller gap is left as padding
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "capacity_share long")
_encoders: dict = {}
_TOO_LONG = "Max stack size exceeded"  # what the pattern of the rank library says to very long runs of blanks


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def _encoder(ranks_path: str):
    """The vocabulary of byte_bpe_50k.json as ranks: the same ids, several times faster."""
    if ranks_path not in _encoders:
        import public_tokenizers
        import tiktoken
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[ranks_path] = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                                  special_tokens={"<|endoftext|>": len(ranks)})
    return _encoders[ranks_path]


def _library(json_path: str):
    if json_path not in _encoders:
        from tokenizers import Tokenizer
        _encoders[json_path] = Tokenizer.from_file(json_path)
    return _encoders[json_path]


def encode(text: str, ranks_path: str, json_path: str) -> list[int]:
    """The ids of a text. A run of blanks that the rank library cannot cut sends this text to the slower JSON library."""
    try:
        return _encoder(ranks_path).encode(text, allowed_special="all")
    except ValueError as error:
        if _TOO_LONG not in str(error):
            raise
        return _library(json_path).encode(text, add_special_tokens=False).ids


class Piece(NamedTuple):
    """Ids of a document from ``start`` on, which its class counts as one rest."""

    doc: int | None
    start: int
    ids: np.ndarray
    total: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:length], self.total), Piece(self.doc, self.start + length, self.ids[length:], self.total)


class Bin:
    """A sequence in the making; ``share`` is the k of its class."""

    def __init__(self, capacity: int, share: int):
        self.gap, self.share, self.pieces = capacity, share, []

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.gap -= len(piece.ids)


class Bins:
    """The open and the waiting bins of one task. ``add`` and ``close`` give the bins that are done."""

    def __init__(self, capacity: int, waiting: int = WAITING, least: int = LEAST):
        self.capacity, self.most_waiting, self.least = capacity, waiting, least
        self.open: dict[int, Bin] = {}
        self.waiting: list[tuple[int, int, Bin]] = []  # by gap, then by age
        self.age = 0

    def _settle(self, bin_: Bin) -> Iterator[Bin]:
        if bin_.gap < self.least:
            yield bin_
        else:
            self.age += 1
            insort(self.waiting, (bin_.gap, self.age, bin_))

    def add(self, piece: Piece) -> Iterator[Bin]:
        """A piece of at most the capacity."""
        size = len(piece.ids)
        at = bisect_left(self.waiting, (size, 0))  # the smallest gap it fits into
        if at < len(self.waiting):
            bin_ = self.waiting.pop(at)[2]
            bin_.put(piece)
            yield from self._settle(bin_)
        elif len(self.waiting) > self.most_waiting and size - self.waiting[-1][0] >= self.least:
            bin_ = self.waiting.pop()[2]  # the largest gap, filled exactly
            first, rest = piece.cut(bin_.gap)
            bin_.put(first)
            yield bin_
            yield from self.add(rest)
        else:
            share = self.capacity // size
            bin_ = self.open.setdefault(share, Bin(self.capacity, share))
            bin_.put(piece)
            if len(bin_.pieces) == share:
                del self.open[share]
                yield from self._settle(bin_)

    def close(self) -> Iterator[Bin]:
        """What is left when no more pieces come: bins with the smallest gaps are filled with the pieces of the others, the rest
        makes sequences, and what is short of one is cut into powers of two, which need no padding."""
        kept = [bin_ for _, _, bin_ in self.waiting]
        stock = [p for bin_ in self.open.values() for p in bin_.pieces]
        self.open, self.waiting = {}, []
        have, gaps = sum(len(p.ids) for p in stock), sum(bin_.gap for bin_ in kept)
        while gaps > have:
            bin_ = kept.pop()
            stock += bin_.pieces
            have, gaps = have + self.capacity - bin_.gap, gaps - bin_.gap
        pieces = deque(sorted(stock, key=lambda p: -len(p.ids)))

        def fill(bin_: Bin, size: int) -> Bin:
            while size:
                piece = pieces.popleft()
                if len(piece.ids) > size:
                    piece, rest = piece.cut(size)
                    pieces.appendleft(rest)
                bin_.put(piece)
                size -= len(piece.ids)
            return bin_
        for bin_ in kept:
            yield fill(bin_, bin_.gap)
        left = have - gaps
        while left:
            size = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            yield fill(Bin(self.capacity, self.capacity // size), size)
            left -= size


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         ranks_path: str | None = None, json_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, capacity_share (k of its class).

    Null and empty texts are one end id. Rows that repeat a key are packed each on their own; a null key stays null. Other
    columns are not read. Tasks hold one open bin per class and at most ``WAITING`` + 1 closed ones with a gap.
    """
    json_path, ranks_path = json_path or tokenizer_paths()[0], ranks_path or tokenizer_paths()[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, count = Bins(capacity), TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def place(done: Bin) -> None:
            nonlocal count
            offset = 0
            for piece in done.pieces:
                length = len(piece.ids)
                rows.append((piece.doc, piece.start, length, zlib.crc32(piece.ids.tobytes()), piece.total, count, offset, done.share))
                offset += length
            count += 1

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], SCHEMA.replace(" long", "").split(", "))

        for batch in blocks(batches, "text"):
            for doc, body in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*(encode(body, ranks_path, json_path) if body else ()), END], "<u4")
                rest = Piece(doc, 0, ids, len(ids))
                while len(rest.ids) >= capacity:
                    whole, rest = rest.cut(capacity)
                    full = Bin(capacity, 1)
                    full.put(whole)
                    place(full)
                if len(rest.ids):
                    for done in bins.add(rest):
                        place(done)
            if rows:
                yield out()
                rows.clear()
        for done in bins.close():
            place(done)
        if rows:
            yield out()

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, SCHEMA)
