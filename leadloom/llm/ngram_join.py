"""N-gram Jaccard join by signature trees.

A document's set is its distinct word n-grams. Two documents link when ``100 * intersection >= percent * union``.
The join is exact and shuffles keys, not texts:

1. Equal sets form a class (128-bit digest); only the smallest id of a class goes on. A class of a third of all rows
   costs one row per map task.
2. The forest's upper level: a class enters the trees of its rarest n-grams only. Ordered from rare to frequent, linked
   sets share at least ``extra`` of their first ``n - ceil(percent * n / 100) + extra`` n-grams, so no linked pair is
   apart; a class that shares fewer with all others has no link and leaves. Order is by the frequency of an n-gram's
   words (those with more than 2^-18 of all), so rare words decide at any size of the corpus; n-grams with more than 2^-20
   of all occurrences come last, so passages which many documents hold open no tree. These two tables, of at most 2^18 and
   2^20 rows, are broadcast. Trees of the same classes are one tree.
3. Every class is compared with the smallest id of most of its trees. What links is joined up; trees whose classes are
   all joined need nothing more. This makes large families of near copies cheap without leaving pairs out.
4. The other trees: leaves hold a class's size and a bitmap of its n-grams (about four bits each), nodes the OR of their
   children's bitmaps and the range of sizes. A dual traversal from (root, root) drops node pairs whose largest possible
   overlap is too small, or which are joined already. Trees over ``tile`` classes are cut into tiles that meet pair by
   pair.
5. Pairs that remain are checked on the whole sets. Components come from large and small stars.

Sets of classes that share an n-gram are computed again from the texts instead of being stored for all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.exprs import fresh_name
from leadloom.llm.links import components
from leadloom.llm.tokens import blocks, find_words, hash_words, mix, sets_of, shingles, text_bytes
from leadloom.session import staged

HOT_SHARE = 20  # an n-gram is frequent from 2^-20 of all occurrences on
WORD_SHARE = 18  # a word is frequent from 2^-18 on
LEAST_BITS = 512  # of a bitmap; a power of two with at least four bits for each n-gram
FANOUT = 8
ONE_NODE = 32  # classes of a tree that is one node
EXTRA = 4  # a quarter more n-grams than needed to share one, so that linked sets share that many more
TILE = 1024
BROADCAST_IDS = 500_000  # ids that may be broadcast (8 bytes each); beyond, the join shuffles


def frequencies(docs: DataFrame, text: str, words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Frequent n-grams and frequent words with their counts, ascending. Only the order of n-grams depends on them, no result."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text, 4 << 20):
            data, at = text_bytes(batch.column(text))
            found = find_words(data, at)
            hashes = hash_words(data, found)
            grams = shingles(hashes, found.text, len(at) - 1, words)[0]
            for kind, values in ((0, grams), (1, hashes)):
                kinds, times = np.unique(values, return_counts=True)
                keep = times >= 3  # what a block holds less often is not counted; that can only change the order
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(keep.sum() + 1, kind, np.int32)), pa.array(np.append(kinds[keep].view(np.int64), 0)),
                    pa.array(np.append(times[keep], 0)), pa.array(np.append(np.zeros(keep.sum(), np.int64), len(values)))],
                    ["kind", "value", "times", "size"])

    parts = staged(docs.select(text).mapInArrow(count, "kind int, value long, times long, size long"), "frequent")
    sizes = {r["kind"]: r["size"] for r in parts.groupBy("kind").agg(F.sum("size").alias("size")).collect()}
    tables = []
    for kind, share in ((0, HOT_SHARE), (1, WORD_SHARE)):
        hot = parts.where(f"times > 0 AND kind = {kind}").groupBy("value").agg(F.sum("times").alias("times"))
        hot = hot.where(F.col("times") > (sizes.get(kind, 0) >> share)).toPandas()  # bounded by the share
        hot = hot.assign(value=hot["value"].to_numpy(np.int64).view(np.uint64)).sort_values("value")
        tables.append((hot["value"].to_numpy(np.uint64), hot["times"].to_numpy(np.int64)))
    return tables


def _counts(table: tuple[np.ndarray, np.ndarray], values: np.ndarray) -> np.ndarray:
    """The counts of values in a table, 0 if they are not in it."""
    kinds, times = table
    if not len(kinds) or not len(values):
        return np.zeros(len(values), np.int64)
    place = np.minimum(np.searchsorted(kinds, values), len(kinds) - 1)
    return np.where(kinds[place] == values, times[place], 0)


def _prefixes(docs: DataFrame, key: str, text: str, words: int, percent: int, hot) -> DataFrame:
    """key, n, digest of the set, its rarest n-grams (``rare``)."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def rare(values: np.ndarray, order: np.ndarray) -> np.ndarray:
        n = len(values)
        spare = n - -(-percent * n // 100)
        want = spare + 1 + spare // EXTRA if n else 0
        return values[np.lexsort((mix(values), order))[:want]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, known = shared.value
        for batch in blocks(batches, text):
            data, at = text_bytes(batch.column(text))
            found = find_words(data, at)
            hashes = hash_words(data, found)
            rank = (8 * np.log2(_counts(known, hashes) + 1)).astype(np.int64)
            values, owner, order = shingles(hashes, found.text, len(at) - 1, words, rank)
            often = _counts(grams, values)
            order = np.where(often > 0, (1 << 20) + often, order)
            edge = np.searchsorted(owner, np.arange(len(at)))
            sizes, digests, heads = [], [], []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                own, first = np.unique(values[a:b], return_index=True)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                heads.append(rare(own, order[a:b][first]))
            cut = np.concatenate(([0], np.cumsum([len(h) for h in heads]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(key), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(heads).view(np.int64)))],
                ["id", "n", "digest", "rare"])

    return docs.select(key, text).mapInArrow(run, "id long, n long, digest binary, rare array<long>")


def _bitmaps(docs: DataFrame, words: int) -> DataFrame:
    """id, n (size of its set), bits (a bitmap of its n-grams)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            sets, maps = sets_of(batch.column("text"), words), []
            for s in sets:
                width = max(LEAST_BITS, 1 << (4 * len(s) - 1).bit_length())
                bits = np.zeros(width // 64, np.uint64)
                spot = (mix(s) & np.uint64(width - 1)).astype(np.int64)
                np.bitwise_or.at(bits, spot >> 6, np.uint64(1) << (spot & 63).astype(np.uint64))
                maps.append(bits.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array(maps, pa.binary())], ["id", "n", "bits"])

    return docs.select("id", "text").mapInArrow(run, "id long, n long, bits binary")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """id, other, its n-grams ascending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            sets = sets_of(batch.column("text"), words)
            edge = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("other"), pa.ListArray.from_arrays(
                pa.array(edge), pa.array(np.concatenate(sets).view(np.int64)))], ["id", "other", "grams"])

    return docs.select("id", "other", "text").mapInArrow(run, "id long, other long, grams array<long>")


def _hinted(df: DataFrame) -> DataFrame:
    """Broadcast if the (stored) table is short enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _linked(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b), stored, whose whole sets are similar enough. A set travels once per pair, to its partner a."""
    ones = staged(pairs.select(F.col("a").alias("id")).distinct(), "ones")
    two = docs.join(_hinted(pairs.select(F.col("b").alias("id"), F.col("a").alias("other"))), "id")
    one = docs.join(_hinted(ones), "id").withColumn("other", F.col("id"))
    left = _sets(two, words).select(F.col("other").alias("a"), F.col("id").alias("b"), F.col("grams").alias("gb"))
    right = _sets(one, words).select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    both = F.size(F.array_intersect("ga", "gb"))
    return (left.join(right, "a").select("a", "b", both.alias("both"), (F.size("ga") + F.size("gb")).alias("sizes"))
            .where(100 * F.col("both") >= percent * (F.col("sizes") - F.col("both"))).select("a", "b").distinct())


def _possible_pairs(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xa, xb = (batch.column(c).to_pylist() for c in ("xa", "xb"))
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            widths, ok = np.array([min(len(x), len(y)) // 8 for x, y in zip(xa, xb)]), np.zeros(batch.num_rows, bool)
            for width in np.unique(widths).tolist():
                mine = np.flatnonzero(widths == width)
                leaves = [_leaves([x[k] for k in mine.tolist()], n[mine], np.full(len(mine), -1), width)
                          for x, n in ((xa, na), (xb, nb))]
                ok[mine] = _possible(leaves[0], np.arange(len(mine)), leaves[1], np.arange(len(mine)), percent)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    known = pairs.join(bitmaps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa")), "a")
    known = known.join(bitmaps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb")), "b")
    return known.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a long, b long")


def _leaves(maps: list[bytes], n: np.ndarray, joined: np.ndarray, width: int) -> tuple:
    """Bitmaps folded to ``width`` words, the bits set in them, sizes (low and high) and what each leaf is joined to."""
    bits = np.empty((len(maps), width), np.uint64)
    for k, m in enumerate(maps):
        bits[k] = np.bitwise_or.reduce(np.frombuffer(m, np.uint64).reshape(-1, width), axis=0)
    return bits, np.bitwise_count(bits).sum(1, dtype=np.int64), n, n, joined


class _Tree:
    """A signature tree over one group of classes, leaves in order of size."""

    def __init__(self, leaves: tuple):
        self.levels = [leaves]
        while len(self.levels[-1][0]) > 1:
            b, pop, low, high, grp = self.levels[-1]
            cut = np.arange(0, len(b), FANOUT)
            first, last = np.minimum.reduceat(grp, cut), np.maximum.reduceat(grp, cut)
            self.levels.append((np.bitwise_or.reduceat(b, cut, axis=0), np.minimum.reduceat(pop, cut),
                                np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut),
                                np.where(first == last, first, -1)))


def _possible(x, i, y, j, percent: int) -> np.ndarray:
    """Whether nodes i of level x and j of level y can hold a linked pair that is not joined yet."""
    keep = np.empty(len(i), bool)
    for s in range(0, len(i), 1 << 15):
        a, b = i[s:s + (1 << 15)], j[s:s + (1 << 15)]
        common = np.bitwise_count(x[0][a] & y[0][b]).sum(1, dtype=np.int64)
        only_a, only_b = np.maximum(x[1][a] - common, 0), np.maximum(y[1][b] - common, 0)
        most = np.minimum(x[3][a] - only_a, y[3][b] - only_b)
        ok = 100 * most >= percent * (most + only_a + only_b)
        ok &= 100 * np.minimum(x[3][a], y[3][b]) >= percent * np.maximum(x[2][a], y[2][b])
        keep[s:s + (1 << 15)] = ok & ((x[4][a] != y[4][b]) | (x[4][a] < 0))
    return keep


def tree_pairs(one: _Tree, two: _Tree | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs that survive the dual traversal; a tree with itself if ``two`` is None."""
    own, two = two is None, two or one
    i = j = np.zeros(1, np.int64)
    p, q = len(one.levels) - 1, len(two.levels) - 1
    while True:
        ok = _possible(one.levels[p], i, two.levels[q], j, percent)
        i, j = i[ok], j[ok]
        if p == q == 0:
            if own:
                i, j = i[i < j], j[i < j]
            return i, j
        step_i, step_j = p > 0 and p >= q, q > 0 and q >= p
        if step_i:
            i, j = np.repeat(i * FANOUT, FANOUT) + np.tile(np.arange(FANOUT), len(i)), np.repeat(j, FANOUT)
            p -= 1
        if step_j:
            i, j = np.repeat(i, FANOUT), np.repeat(j * FANOUT, FANOUT) + np.tile(np.arange(FANOUT), len(j))
            q -= 1
        ok = (i < len(one.levels[p][0])) & (j < len(two.levels[q][0]))
        if own:
            ok &= i <= j
        i, j = i[ok], j[ok]


def _segments(n: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Ranges of ascending sizes between which no pair can link."""
    cut = np.flatnonzero(100 * n[:-1] < percent * n[1:]) + 1
    edge = [0, *cut.tolist(), len(n)]
    return list(zip(edge[:-1], edge[1:]))


def _tree_group(rows: pd.DataFrame, percent: int) -> Iterator[pd.DataFrame]:
    """Candidates of one tile (its own tree) or of two tiles (two trees)."""
    rows = rows.drop_duplicates("id").sort_values(["n", "id"], ignore_index=True)
    tiles = rows["tile"].unique()
    for a, b in _segments(rows["n"].to_numpy(), percent):
        part = rows.iloc[a:b]
        width = min(map(len, part["bits"])) // 8
        sides = [part[part["tile"] == t] for t in tiles]
        if all(len(x) for x in sides):
            trees = [_Tree(_leaves(x["bits"].tolist(), x["n"].to_numpy(np.int64), x["joined"].to_numpy(np.int64), width)) for x in sides]
            i, j = tree_pairs(trees[0], trees[1] if len(trees) > 1 else None, percent)
            x, y = sides[0]["id"].to_numpy()[i], sides[-1]["id"].to_numpy()[j]
            yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})


def _whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by ``keys`` cut where a group ends."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if len(rows):
            last = (rows[keys] == rows[keys].iloc[-1]).all(axis=1).to_numpy()
            edge = len(rows) - int(np.argmin(last[::-1])) if not last.all() else 0
            if edge:
                yield rows.iloc[:edge]
            rest = rows.iloc[edge:]
    if rest is not None and len(rest):
        yield rest


def _node_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Candidates of the trees of one node, all trees of a batch at once; members: gram, id, n, joined, bits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_groups(batches, ["gram"]):
            gram, ids, n, joined = (rows[c].to_numpy() for c in ("gram", "id", "n", "joined"))
            bits = rows["bits"].tolist()
            start = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
            size = np.diff(np.append(start, len(gram)))
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for m in np.unique(size[size > 1]).tolist():
                i, j = np.triu_indices(m, 1)
                at = start[size == m][:, None]
                x, y = (at + i).ravel(), (at + j).ravel()
                ok = (joined[x] != joined[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (ids[x] != ids[y])
                left.append(x[ok])
                right.append(y[ok])
            x, y = np.concatenate(left), np.concatenate(right)
            x, y = np.where(ids[x] < ids[y], x, y), np.where(ids[x] < ids[y], y, x)
            _, once = np.unique(np.stack((ids[x], ids[y])), axis=1, return_index=True)
            x, y = x[once], y[once]
            width = np.array([min(len(bits[p]), len(bits[q])) // 8 for p, q in zip(x.tolist(), y.tolist())], np.int64)
            for w in np.unique(width).tolist():
                for p, q in zip(*[np.array_split(side[width == w], 1 + (width == w).sum() * w // (1 << 21)) for side in (x, y)]):
                    used, place = np.unique(np.concatenate((p, q)), return_inverse=True)
                    leaves = _leaves([bits[k] for k in used.tolist()], n[used], joined[used], w)
                    ok = _possible(leaves, place[:len(p)], leaves, place[len(p):], percent)
                    if ok.any():
                        yield pd.DataFrame({"a": ids[p[ok]], "b": ids[q[ok]]})

    return (members.select("gram", "id", "n", "joined", "bits").repartition("gram").sortWithinPartitions("gram")
            .mapInPandas(run, "a long, b long").distinct())


def _traverse(members: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of larger trees; members: gram, id, n, joined, bits, tiles (how many the tree is cut into)."""
    tile = F.pmod(F.xxhash64("id"), F.col("tiles"))
    spread = members.withColumn("tile", tile).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    spread = spread.withColumn("one", F.least("tile", "other")).withColumn("two", F.greatest("tile", "other"))
    order = ["gram", "one", "two"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_groups(batches, order):
            found = [p for _, g in rows.groupby(order, sort=False) for p in _tree_group(g, percent)]
            if found:
                yield pd.concat(found, ignore_index=True).drop_duplicates()

    return (spread.repartition(*order).sortWithinPartitions(*order)
            .select("gram", "one", "two", "tile", "id", "n", "joined", "bits")
            .mapInPandas(run, "a long, b long").distinct())


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
                       tile: int = TILE) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles (size of its set), component_id (smallest key reachable by links).

    Null and empty texts have an empty set, which links with nothing; their component is their own key. Rows with a null
    key have a null component and link nothing. Rows that share a key are one node of the graph. Other columns, whatever
    their names, are not read.
    """
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    every = staged(_prefixes(docs, "id", "text", words, percent, frequencies(docs, "text", words)), "prefixes")
    real = every.where("n > 0 and id is not null")
    classes = real.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    copies = real.select("id", "digest").join(classes.where("copies > 1"), "digest").where("id <> rep")
    copies = staged(copies.select("id", "digest").distinct(), "copies")
    entries = real.join(_hinted(copies), ["id", "digest"], "left_anti").select("id", "n", F.explode("rare").alias("gram"))
    trees = entries.groupBy("gram").agg(F.count("*").alias("classes")).where("classes > 1")
    members = staged(entries.join(trees.select("gram"), "gram"), "members")
    # the least that a linked class shares with this one: that of the smallest size that can link
    least_size = F.expr(f"({percent} * n + 99) div 100")
    need = least_size - F.expr(f"({percent} * (({percent} * n + 99) div 100) + 99) div 100")
    enough = members.groupBy("id", "n").agg(F.count("*").alias("shared")).where(F.col("shared") >= 1 + F.floor(need / EXTRA))
    members = members.join(enough.select("id", "n"), ["id", "n"])
    same = [F.sum(F.xxhash64("id", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)]
    trees = members.groupBy("gram").agg(F.count("*").alias("classes"), F.min("id").alias("least"), *same).where("classes > 1")
    trees = trees.groupBy("classes", "least", "s1", "s2").agg(F.min("gram").alias("gram"), F.count("*").alias("times"))
    members = staged(members.join(trees.select("gram", "least", "times"), "gram"), "trees")

    active = staged(members.select("id").distinct(), "active")
    docs = docs.where("id IS NOT NULL")
    bitmaps = staged(_bitmaps(docs.join(_hinted(active), "id", "left_semi"), words), "bitmaps")
    first = members.where("least < id").groupBy("id", "least").agg(F.sum("times").alias("times"))
    first = first.groupBy(F.col("id").alias("b")).agg(F.max_by("least", F.struct("times", -F.col("least"))).alias("a")).select("a", "b")
    first = staged(_possible_pairs(first, bitmaps, percent), "first")
    stars = staged(_linked(first, docs, words, percent), "stars")

    joined = members.select("id").distinct().join(stars.select(F.col("b").alias("id"), "a"), "id", "left")
    joined = joined.select("id", F.coalesce("a", "id").alias("joined"))
    for _ in range(2):  # each step follows twice as many links; a joined label never lies, it may only be too fine
        up = joined.select(F.col("id").alias("joined"), F.col("joined").alias("next"))
        joined = staged(joined.join(up, "joined", "left").select("id", F.coalesce("next", "joined").alias("joined")), "joined")
    known = members.join(joined, "id")
    open_trees = known.groupBy("gram").agg(F.min("joined").alias("j0"), F.max("joined").alias("j1"),
                                           F.min("n").alias("n0"), F.max("n").alias("n1"), F.count("*").alias("rows"))
    # of a tree of two, the sizes tell whether it can hold a link; bitmaps are sent for the others
    open_trees = open_trees.where(f"j0 <> j1 AND (rows > 2 OR 100 * n0 >= {percent} * n1)")
    rows = staged(known.join(open_trees.select("gram", "rows"), "gram"), "open")
    rows = rows.join(bitmaps.select("id", "bits"), "id")
    large = rows.where(f"rows > {ONE_NODE}").withColumn("tiles", F.ceil(F.col("rows") / tile))
    pairs = staged(_node_pairs(rows.where(f"rows <= {ONE_NODE}"), percent).union(_traverse(large, percent)).distinct(), "pairs")
    links = staged(_linked(pairs, docs, words, percent).union(stars), "links")

    graph = components(links).withColumnRenamed("id", "rep")
    graph = classes.join(graph, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = every.join(graph, "digest", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                      percent: int = 80) -> DataFrame:
    """The documents without near copies: of every component the row with the smallest key stays, with all its columns.

    Rows without a key or without words stay. Of rows that repeat a key, one stays: the smallest text.
    """
    mark, head = fresh_name(docs, "marked"), fresh_name(docs, "head")
    groups = staged(jaccard_components(docs, key, text, words, percent), "groups")
    gone = staged(groups.where(f"`{key}` <> component_id").select(F.col(key).alias(mark)).distinct(), "gone")
    kept = docs.join(_hinted(gone), docs[key] == F.col(mark), "left_anti")
    twice = staged(groups.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
                   .select(F.col(key).alias(mark)), "twice")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, kept[key] == F.col(mark), "left_semi")
    # maps cannot be compared: rows are ordered by their text and then by their JSON, and come back whole
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = again.groupBy(key).agg(F.min_by(row, F.struct(F.col(text).isNull(), F.col(text), F.to_json(row))).alias(head))
    one = one.select(*[F.col(head).getField(c).alias(c) for c in docs.columns])
    return kept.join(twice, kept[key] == F.col(mark), "left_anti").unionByName(one)
