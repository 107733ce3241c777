"""Repeated passages by content-defined chunks.

A gear hash over the last 32 bytes of the text decides where a chunk ends, so an inserted word moves the ends near it
only. Chunks have about 32 bytes. A chunk is a duplicate if its digest was met before, in order of (document, position);
neighbouring duplicates form spans, and spans of at least ``least_bytes`` bytes are repeats that can be cut out. The first
copy of a passage stays. Digests travel, texts do not; digests are counted by map-side aggregates, and the join on the
repeated ones has both sides shuffled by Spark, which splits what is skewed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.tokens import blocks, text_bytes
from leadloom.session import staged

WINDOW = 32  # bytes that decide an end
MASK = np.uint32(((1 << 5) - 1) << 24)  # five bits: 32 bytes between ends on average; bits up there see the last 25 bytes
LONGEST = 1 << 16  # an end is set there if none was found: a text of one repeated byte has ends everywhere or nowhere
LEAST_BYTES = 128
NAMING = 16  # bytes of a chunk that tells which document a passage was copied from
_GEAR = np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after every byte, of the last 32 bytes: h = (h << 1) + gear[byte], five doublings at a time."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(step) if step < len(h) else 0
        h = h + shifted
    return h


def ends(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte after every chunk, in all texts; a text's last byte ends its last chunk.

    The hash runs on over the start of a text; what it sees of the text before is cancelled by asking for ends at least 32
    bytes into a text.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    found = np.flatnonzero((gear(data) & MASK) == 0) + 1
    owner = np.searchsorted(at, found, side="left") - 1
    found = found[found - at[owner] >= WINDOW]
    all_ends = np.unique(np.concatenate((found, at[1:][np.diff(at) > 0])))
    begin = np.concatenate(([0], all_ends[:-1]))
    far = np.flatnonzero(all_ends - begin > LONGEST)
    more = [np.arange(begin[k] + LONGEST, all_ends[k], LONGEST) for k in far]
    return np.unique(np.concatenate((all_ends, *more))) if more else all_ends


def chunks(docs: DataFrame) -> DataFrame:
    """doc, row (a number of the row), size, chunk ends and chunk digests of every text (columns id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            data, at = text_bytes(batch.column("text"))
            stop = ends(data, at)
            begin = np.concatenate(([0], stop[:-1])).astype(np.int64) if len(stop) else stop
            raw = data.tobytes()
            digest = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(begin.tolist(), stop.tolist())),
                                 np.uint64, len(stop)).view(np.int64)
            edge = np.searchsorted(stop, at, side="right").astype(np.int32)
            local = (stop - at[np.searchsorted(at, stop, side="left") - 1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("row"), pa.array(np.diff(at)),
                pa.ListArray.from_arrays(pa.array(edge), pa.array(local)),
                pa.ListArray.from_arrays(pa.array(edge), pa.array(digest))], ["id", "row", "bytes", "ends", "digests"])

    return docs.mapInArrow(run, "id long, row long, bytes long, ends array<int>, digests array<long>")


def _spans(flag: np.ndarray, start: np.ndarray, end: np.ndarray, least: int) -> list[tuple[int, int]]:
    """First and last chunk of the runs of flagged chunks that cover at least ``least`` bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flag.astype(np.int8), [0]))))
    runs = zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())
    return [(a, b) for a, b in runs if end[b] - start[a] >= least]


def _marked(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in zip(*[batch.column(n) for n in ("id", "bytes", "ends", "digests", "dup", "first")]):
                key, size = row[0].as_py(), row[1].as_py()
                end, digest = row[2].values.to_numpy(), row[3].values.to_numpy()
                start = np.concatenate(([0], end[:-1])) if len(end) else end
                first = np.full(len(end), _LAST if key is None else key)
                known = np.zeros(len(end), bool)
                if row[4].is_valid and len(end):
                    dup, owner = row[4].values.to_numpy(), row[5].values.to_numpy()
                    order = np.argsort(dup)
                    place = order[np.minimum(np.searchsorted(dup, digest, sorter=order), len(dup) - 1)]
                    known = dup[place] == digest
                    first = np.where(known, owner[place], first)
                _, earliest, which = np.unique(digest, return_index=True, return_inverse=True)
                inner = earliest[which] < np.arange(len(end))
                many = np.bincount(which)[which] > 1 if len(end) else known
                before = inner | (first < (_LAST if key is None else key))
                runs = _spans(before, start, end, least)
                long = end - start  # a chunk of a few bytes says nothing about where a passage comes from
                best = [a + int(np.argmax(long[a:b + 1])) for a, b in runs]
                spans = [{"start": int(start[a]), "end": int(end[b]), "first_doc": None if first[k] == _LAST else int(first[k])}
                         for (a, b), k in zip(runs, best)]
                shared = _spans(known | many, start, end, least)
                docs = sorted({int(first[k]) for a, b in runs for k in range(a, b + 1)
                               if first[k] != _LAST and long[k] >= NAMING} - {key})
                out.append((key, size, len(end), int(before.sum()), spans, docs, sum(s["end"] - s["start"] for s in spans),
                            sum(int(end[b] - start[a]) for a, b in shared)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), _OUT.types)], schema=_OUT)
    return run


_LAST = np.int64(2**63 - 1)  # stands for a null key
_OUT = pa.schema([("id", pa.int64()), ("bytes", pa.int64()), ("n_chunks", pa.int64()), ("dup_chunks", pa.int64()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_doc", pa.int64())]))),
                  ("first_docs", pa.list_(pa.int64())), ("repeated_bytes", pa.int64()), ("shared_bytes", pa.int64())])


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """One row per row of ``docs``: key, bytes, n_chunks, dup_chunks (met in a document of a smaller key, or before in the
    same text), spans of at least ``least_bytes`` bytes of such chunks (start and end in bytes of the UTF-8 text, first_doc:
    the smallest key that holds the longest chunk), first_docs (such keys of all chunks of 16 bytes or more), repeated_bytes (in spans) and shared_bytes
    (in spans of chunks that any other place holds too, so the first copy shows as well).

    Null and empty texts have no chunk. Rows that share a key count as one document. A null key counts as largest.
    Other columns are not read.
    """
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    table = staged(chunks(docs.withColumn("row", F.monotonically_increasing_id())), "chunks")
    each = table.select("row", F.coalesce("id", F.lit(int(_LAST))).alias("id"), F.explode(F.array_distinct("digests")).alias("digest"))
    firsts = each.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("times")).where("times > 1")
    again = each.select("row", "digest").join(firsts.select("digest", "first"), "digest")
    marks = again.groupBy("row").agg(F.collect_list(F.struct("digest", "first")).alias("dups"))  # at most a text's chunks
    marks = marks.select("row", F.col("dups.digest").alias("dup"), F.col("dups.first").alias("first"))
    held = table.join(marks, "row", "left").select("id", "bytes", "ends", "digests", "dup", "first")
    found = held.mapInArrow(_marked(least_bytes), "id long, bytes long, n_chunks long, dup_chunks long, "
                            "spans array<struct<start:bigint,end:bigint,first_doc:bigint>>, first_docs array<bigint>, "
                            "repeated_bytes long, shared_bytes long")
    return found.withColumnRenamed("id", key)
