"""Token counts of texts under a byte-level BPE vocabulary, without encoding them.

A text is cut into pre-tokens as the vocabulary's library cuts it. ``whole_tokens`` proves on the driver, once per
vocabulary, which strings are one pre-token and merge to one token; merging looks at nothing but its pre-token, so such a
string counts one wherever it stands. Only other pre-tokens are merged, by the library's own model, and a task keeps the
sizes of short ones.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.tokens import blocks

LIMIT = 512  # tokens over which a text counts as long
STRETCH = 1 << 20  # characters cut into pre-tokens at once
KEPT, KEPT_CHARS = 500_000, 64  # sizes a task keeps, and the longest pre-token it keeps one for
# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRE_TOKEN, _STRETCH_END = regex.compile(PATTERN), regex.compile(r"(?<=\S)\s")
_STANDS_FOR = {"L": "a", "N": "1", "O": "!", "S": " "}  # one character of each class; none is part of a contraction
_CLASS_HERE = regex.compile(r"(?P<L>\p{L})|(?P<N>\p{N})|(?P<S>\s)|(?P<O>.)", regex.S)


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where it has a shape, else the
    next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Vocabulary:
    """What the library does with one text, in parts. ``file`` must describe a plain byte-level BPE."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer
        with open(file, encoding="utf-8") as source:
            parts = json.load(source)
        pre, model, added = parts["pre_tokenizer"] or {}, parts["model"], parts["added_tokens"]
        plain = (pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True) and not parts["normalizer"]
                 and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                                               "end_of_word_suffix")))
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{file} is no plain byte-level BPE vocabulary")
        library = Tokenizer.from_file(file)
        self.cut, self.merge = library.pre_tokenizer.pre_tokenize_str, library.model.tokenize
        self.strings = list(model["vocab"])
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.bytes_of = {c: b for b, c in self.letters.items()}
        self.classes: dict[str, str] = {}  # non-ASCII characters asked for so far, and the library's class of each

    def size(self, pre_token: str) -> int:
        return len(self.merge(pre_token.encode().decode("latin-1").translate(self.letters)))

    def odd(self, text: str) -> dict[int, str]:
        """The characters of the text that the library's Unicode tables class otherwise than ours, each with a character
        that both class alike. Every character is asked of the library once per task."""
        out = {}
        for c in () if text.isascii() else set(text):
            if c > "\x7f":
                if c not in self.classes:
                    self.classes[c] = next((k for k in "LNO" if len(self.cut(_STANDS_FOR[k] + c)) == 1), "S")
                if _CLASS_HERE.match(c).lastgroup != self.classes[c]:
                    out[ord(c)] = _STANDS_FOR[self.classes[c]]
        return out

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text without special strings, a stretch at a time. A stretch ends between a character and
        a blank, where a pre-token always ends."""
        odd, at = self.odd(text), 0
        same_length = text.translate(odd) if odd else text
        while at < len(text):
            cut = _STRETCH_END.search(same_length, at + STRETCH)
            end = cut.start() if cut else len(text)
            if odd:
                yield [text[m.start():m.end()] for m in _PRE_TOKEN.finditer(same_length, at, end)]
            else:
                yield _PRE_TOKEN.findall(text, at, end)
            at = end


@cache
def vocabulary(file: str) -> Vocabulary:
    return Vocabulary(file)


def whole_tokens(vocab: Vocabulary) -> frozenset[str]:
    """The vocabulary strings that are a text, are cut into one pre-token, and merge to one token."""
    out = set()
    for shown in vocab.strings:
        try:
            text = bytes(vocab.bytes_of[c] for c in shown).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # no text by itself: part of a character
        if len(vocab.cut(text)) == 1 and vocab.size(text) == 1 and not (vocab.special and vocab.special.search(text)):
            out.add(text)
    return frozenset(out)


class Sizes:
    """Token counts of texts, for one task."""

    def __init__(self, vocab: Vocabulary, whole: frozenset[str]):
        self.vocab, self.whole, self.known = vocab, whole, {}

    def _merged(self, pre_token: str) -> int:
        if len(pre_token) > KEPT_CHARS:
            return self.vocab.size(pre_token)
        if pre_token not in self.known:
            if len(self.known) >= KEPT:
                self.known.clear()
            self.known[pre_token] = self.vocab.size(pre_token)
        return self.known[pre_token]

    def of(self, text: str) -> int:
        special = self.vocab.special
        parts = special.split(text) if special else [text]
        total = len(parts) - 1  # one token for every special string between the parts
        for part in parts:
            for stretch in self.vocab.pre_tokens(part):
                for pre_token, n in Counter(stretch).items():
                    total += n if pre_token in self.whole else n * self._merged(pre_token)
        return total


def token_counts(docs: DataFrame, file: str | None = None, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key as it is, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have no bytes and no tokens. Repeated keys give a row each, a null key stays null, an empty table
    gives an empty one; other columns are not read, whatever their names. Special strings of the vocabulary count as one
    token each, as the library's default has it. Texts are read whole, a stretch at a time.
    """
    file = file or vocabulary_path()
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(vocabulary(file)))  # at most one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(vocabulary(file), whole.value)
        for batch in blocks(batches, "text"):
            counts = [sizes.of(t) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                                             ["key", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long").select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
