"""Merkle manifest of a table: a binary hash tree over the rows of each group, and one over the groups' roots.

Time-forward processing. A node's label is (level, place); nodes are taken in label order and every node sends its digest
to its parent through a priority queue ordered by label. The queue is external: a message between tasks is a row, sorted
and spilled by Spark's shuffle, and a task takes one range of labels (a subtree of ``HEIGHT`` levels, so at most 2^HEIGHT
leaves) with a heap for the messages inside it. A round of tasks per ``HEIGHT`` levels leads up to the root; the reversed
sweep leads down again and hands every child its proof suffix, the parent's own with one sibling before it.
"""

from __future__ import annotations

import heapq
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.session import staged

HEIGHT = 10  # levels of one task's subtree
_HEX = str.maketrans("", "", "LR-")


def digest_of(*values: Column) -> Column:
    """SHA-256 (lower-case hex) of the values behind each other: ``-`` for null, else UTF-8 byte count, ``:`` and value."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def upward(leaves: list[str], levels: int) -> list[list[str]]:
    """The digests of a subtree by level, leaves first. The queue holds (parent's level, parent's place, child, digest)."""
    nodes: list[list[str]] = [leaves, *([] for _ in range(levels))]
    queue = [(1, i >> 1, i, digest) for i, digest in enumerate(leaves)] if levels else []  # in order, so a heap
    while queue:
        level, place, _, digests = heapq.heappop(queue)
        while queue and queue[0][:2] == (level, place):
            digests += heapq.heappop(queue)[3]
        nodes[level].append(sha(digests))
        if level < levels:
            heapq.heappush(queue, (level + 1, place >> 1, place, nodes[level][-1]))
    return nodes


def downward(nodes: list[list[str]], suffix: str) -> list[str]:
    """The proof of every leaf of a subtree whose top has the proof ``suffix``: per level a sibling's side (L, R) and digest,
    or ``-`` where a node is alone."""
    above = [suffix]
    for level in reversed(nodes[:-1]):
        here = []
        for place in range(len(level)):
            other = place ^ 1
            step = "-" if other >= len(level) else ("L" if other < place else "R") + level[other]
            here.append(step + above[place >> 1])
        above = here
    return above


def fold(digest: str, proof: str) -> str:
    """The root that a digest and its proof give."""
    at = 0
    while at < len(proof):
        side, other = proof[at], proof[at + 1:at + 65]
        digest = sha(digest if side == "-" else other + digest if side == "L" else digest + other)
        at += 1 if side == "-" else 65
    return digest


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``place`` (0, 1, ... within the group by ``order``) and ``size`` (of the group).

    The rows are dealt out and sorted by range and written once; places are counts of earlier ranges plus a row's place in
    its own. Equal rows are told apart by their place in the input, so that a hot row does not fill one range.
    """
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(group, *order, "_tie")
    dealt = dealt.sortWithinPartitions(group, *order, "_tie").drop("_tie").withColumns({
        "_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    dealt = staged(dealt, "ranges")
    parts = dealt.groupBy(group, "_range").agg(F.count("*").alias("n"), F.min("_row").alias("first"))
    by_group = Window.partitionBy(group)  # as many rows as ranges at most
    parts = parts.withColumns({"size": F.sum("n").over(by_group), "before": F.sum("n").over(by_group.orderBy("_range")) - F.col("n")})
    return dealt.join(parts, [group, "_range"]).withColumn("place", F.col("_row") - F.col("first") + F.col("before")).drop(
        "_range", "_row", "n", "first", "before")


def _blocks(nodes: DataFrame, extra: list[str]) -> DataFrame:
    """One row per subtree: group, size (of the level), block, levels, leaves (digest and ``extra``) in order."""
    width = 1 << HEIGHT
    needed = F.when(F.col("size") > 1, F.length(F.bin(F.col("size") - 1))).otherwise(0)
    return nodes.groupBy("group", "size", F.shiftright("place", HEIGHT).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", *extra))).alias("leaves")).withColumn(  # at most ``width``
        "levels", F.when(F.col("size") > width, HEIGHT).otherwise(needed).cast("int"))


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaves = batch.column("leaves")
        tops = [upward([leaf["digest"] for leaf in leaves[i].as_py()], levels)[-1][0]
                for i, levels in enumerate(batch.column("levels").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("group", "size", "block")] + [pa.array(tops, pa.string())],
                                         ["group", "size", "place", "digest"])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            nodes = upward([leaf["digest"] for leaf in row["leaves"]], row["levels"])
            proofs = downward(nodes, row["suffix"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["group"]] * len(proofs), pa.string()), pa.array([leaf["place"] for leaf in row["leaves"]], pa.int64()),
                 pa.array(proofs, pa.string()), pa.array([row["subroot"] or nodes[-1][0]] * len(proofs), pa.string())],
                ["group", "block", "suffix", "subroot"])


def upward_rounds(nodes: DataFrame, extra: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """From nodes (group, size, place, digest, ``extra``) to the subtrees of every round and the group's roots (group, digest).

    The driver reads one number, the largest group's size, which gives the number of rounds."""
    rounds = [staged(_blocks(nodes, extra), "subtrees")]
    size = rounds[0].agg(F.max("size")).first()[0] or 0
    while True:
        tops = rounds[-1].mapInArrow(_tops, "group string, size long, place long, digest string").withColumn(
            "size", F.ceil(F.col("size") / (1 << HEIGHT)).cast("long"))
        tops = staged(tops, "tops")
        if size <= 1 << HEIGHT:
            return rounds, tops.select("group", "digest")
        size = -(-size >> HEIGHT)
        rounds.append(staged(_blocks(tops, []), "subtrees"))


def downward_rounds(rounds: list[DataFrame], suffixes: DataFrame) -> DataFrame:
    """The first round's subtrees with suffix and subroot, from the roots' own (group, block 0, suffix, subroot)."""
    for subtrees in reversed(rounds[1:]):
        suffixes = subtrees.join(suffixes, ["group", "block"]).mapInArrow(
            _suffixes, "group string, block long, suffix string, subroot string")
    return rounds[0].join(suffixes, ["group", "block"])


def manifest(rows: DataFrame, fields: list[str], group: str = "lang", key: str = "doc_id", tampered: Column | None = None,
             changed: dict[str, Column] | None = None) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256 (all of ``rows`` as they are), folded_root and verified.

    A leaf is the digest of ``fields``, in that order. Leaves of a group ascend by key (null first; rows that repeat a key by
    leaf), groups by their value (null first, then by UTF-8 bytes). Where ``tampered`` holds, folded_root starts from the
    leaf of the row with ``changed`` fields and goes on with the original siblings; elsewhere (also where it is null) from
    the original leaf. A null field differs from an empty one. Equal rows are leaves of their own. An empty table gives no
    rows. Other columns are not read, whatever their names. Long texts are hashed where they are read and not moved.
    """
    changed = changed or {}
    tampered = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    name = F.col(group).cast("string")
    leaves = staged(rows.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("group"), F.col(key).alias("key"),
        digest_of(*[F.col(f) for f in fields]).alias("digest"),
        F.when(tampered, digest_of(*[changed.get(f, F.col(f)) for f in fields])).alias("other")), "leaves")
    kind = leaves.schema["key"].dataType.simpleString()
    rounds, subroots = upward_rounds(numbered(leaves, "group", ["key", "digest"]), ["key", "other"])
    groups = numbered(subroots.select(F.lit("").alias("group"), "digest", F.col("group").alias("name")), "group", ["name"])
    upper, roots = upward_rounds(groups, ["name"])
    root = roots.first()
    root = root["digest"] if root else ""
    ends = roots.select("group", F.lit(0).cast("long").alias("block"), F.lit("").alias("suffix"), F.lit("").alias("subroot"))

    def per_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                digests = [leaf["digest"] for leaf in row["leaves"]]
                proofs = downward(upward(digests, row["levels"]), row["suffix"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([leaf["name"] for leaf in row["leaves"]], pa.string()), pa.array([0] * len(proofs), pa.int64()),
                     pa.array(proofs, pa.string()), pa.array(digests, pa.string())], ["group", "block", "suffix", "subroot"])

    def per_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(batch.drop_columns(["leaves"]).to_pylist()):
                struct = batch.column("leaves").slice(at, 1).flatten()
                digests, others = struct.field("digest").to_pylist(), struct.field("other").to_pylist()
                nodes = upward(digests, row["levels"])
                levels, roots_of = len(nodes) - 1, {}
                proofs, folded = downward(nodes, row["suffix"]), []
                inside = [len(p) - len(row["suffix"]) for p in proofs]
                for digest, other, proof, cut in zip(digests, others, proofs, inside):
                    top = fold(other or digest, proof[:cut])
                    if top not in roots_of:  # above the subtree all leaves share their way
                        roots_of[top] = fold(top, proof[cut:])
                    folded.append(roots_of[top])
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [struct.field("key"), pa.array(digests, pa.string()),
                     pa.array([row["subroot"] or nodes[levels][0]] * n, pa.string()), pa.array([root] * n, pa.string()),
                     pa.array([sha(p.translate(_HEX)) for p in proofs], pa.string()), pa.array(folded, pa.string())],
                    ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    below = upper[0].join(downward_rounds(upper, ends).select("group", "block", "suffix"), ["group", "block"])
    suffixes = staged(below.mapInArrow(per_group, "group string, block long, suffix string, subroot string"), "suffixes")
    out = downward_rounds(rounds, suffixes).mapInArrow(
        per_leaf, f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.select(F.col("key").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def document_manifest(docs: DataFrame) -> DataFrame:
    """``manifest`` of documents by language; where 7 divides the CRC-32 of the decimal doc_id, n_chars is tampered with."""
    return manifest(docs, FIELDS, tampered=F.crc32(F.col("doc_id").cast("string")) % 7 == 0, changed={"n_chars": F.col("n_chars") + 1})
