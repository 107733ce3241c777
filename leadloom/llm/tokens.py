"""Words of whole Arrow batches of texts and their 64-bit hashes, in numpy.

A word is a longest run of bytes other than space and ``\\t\\n\\v\\f\\r``. Texts are read as the UTF-8
bytes that Arrow holds; nothing is decoded, cut or copied per word. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 1 << 20  # bytes whose powers are held at once; a longer word is hashed on its own
_P = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_VALUES_LOWER = _VALUES[_LOWER]
_powers: dict[str, np.ndarray] = {}


class Words(NamedTuple):
    """Of every word: first byte, byte after the last, number of its text."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts behind each other, and the place of every text in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[at[0]:at[-1]], at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows so that one holds about ``most`` bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def find_words(data: np.ndarray, at: np.ndarray) -> Words:
    n = len(data)
    inside = ~_SPACE[data]
    begin, finish = inside.copy(), inside.copy()
    if n:
        begin[1:] &= ~inside[:-1]
        finish[:-1] &= ~inside[1:]
        first = at[:-1][at[:-1] < n]  # words do not go on from one text into the next
        begin[first] = inside[first]
        last = at[1:][at[1:] > 0] - 1
        finish[last] = inside[last]
    start = np.flatnonzero(begin)
    return Words(start, np.flatnonzero(finish) + 1, np.searchsorted(at, start, side="right") - 1)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES)
        for name, base in (("up", _P), ("down", pow(_P, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def hash_words(data: np.ndarray, words: Words, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of every word, A-Z taken as a-z if ``lower``; equal words give equal hashes everywhere."""
    values, out = _VALUES_LOWER if lower else _VALUES, np.empty(len(words.start), np.uint64)
    long = np.flatnonzero(words.end - words.start > BLOCK_BYTES // 2)
    part = words.end // (BLOCK_BYTES // 2)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(out)])) if len(out) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        low, high = int(words.start[a]), int(words.end[b - 1])
        if high - low > BLOCK_BYTES:
            continue  # only a block that begins with a long word
        up, down = _power_tables(high - low)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data[low:high]] * up[:high - low])))
        s, e = words.start[a:b] - low, words.end[a:b] - low
        out[a:b] = (sums[e] - sums[s]) * down[s]
    for k in long.tolist():
        word = data[words.start[k]:words.end[k]]
        out[k] = xxhash.xxh3_64_intdigest((_LOWER[word] if lower else word).tobytes())
    for a, b in zip(cuts[:-1], cuts[1:]):  # the words beside a long one in its block
        if words.end[b - 1] - words.start[a] > BLOCK_BYTES:
            for k in range(int(a), int(b)):
                word = data[words.start[k]:words.end[k]]
                if len(word) <= BLOCK_BYTES // 2:
                    s = values[word] * _power_tables(len(word))[0][:len(word)]
                    out[k] = s.sum(dtype=np.uint64)
    return mix(out ^ (words.end - words.start).astype(np.uint64))


def shingles(hashes: np.ndarray, text: np.ndarray, texts: int, n: int,
             weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words, their text numbers, in text order, and the sums of their words' weights; a text with
    fewer words gives one shingle of all of them, a text without words none."""
    weights = np.zeros(len(hashes), np.int64) if weights is None else weights
    count = np.bincount(text, minlength=texts) if len(text) else np.zeros(texts, np.int64)
    begin = np.concatenate(([0], np.cumsum(count)))[:-1]
    odd = np.uint64(0xD6E8FEB86659FD93)
    if len(hashes) >= n:
        whole = np.flatnonzero(text[:len(text) - n + 1] == text[n - 1:])
        acc, heavy = hashes[whole], weights[whole]
        for k in range(1, n):
            acc, heavy = acc * odd + hashes[whole + k], heavy + weights[whole + k]
    else:
        whole, acc, heavy = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values, owner, sums = [mix(acc)], [text[whole]], [heavy]
    for size in range(1, n):
        few = np.flatnonzero(count == size)
        if len(few):
            acc = hashes[begin[few]]
            for k in range(1, size):
                acc = acc * odd + hashes[begin[few] + k]
            values.append(mix(acc + np.uint64(size)))
            owner.append(few)
            sums.append(sum(weights[begin[few] + k] for k in range(size)))
    short = len(values) > 1
    values, owner, sums = np.concatenate(values), np.concatenate(owner), np.concatenate(sums)
    if short:
        order = np.argsort(owner, kind="stable")
        values, owner, sums = values[order], owner[order], sums[order]
    return values, owner, sums


def sets_of(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct shingles of every text, ascending."""
    data, at = text_bytes(texts)
    words = find_words(data, at)
    values, owner, _ = shingles(hash_words(data, words), words.text, len(at) - 1, n)
    edge = np.searchsorted(owner, np.arange(len(at)))
    return [np.unique(values[a:b]) for a, b in zip(edge[:-1], edge[1:])]
