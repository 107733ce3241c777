"""Benchmark decontamination by spaced seeds.

Tokens are runs of letters and digits in lower case. An item leaks into a document if on one alignment (document, item,
shift) at least 11 of 13 consecutive item tokens agree (80 % of all tokens of an item shorter than that). A seed is a few
tokens seen through a mask; the masks of an item's length are such that every pattern of agreement the rule tolerates
leaves one of them whole, so no leak is without a seed (the tests enumerate all patterns). Seeds of the training texts meet
those of the benchmark in a hash join; a hit gives an alignment, and on it whole texts are compared. Items of fewer than
``MIN_TOKENS`` tokens, null or empty ones are no test passages and match nothing. Null and empty documents are clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.exprs import fresh_name, let
from leadloom.session import staged

MASKS = {  # item length (the last: and above) -> masks, token positions that count
    5: ((0, 1, 2), (0, 1, 3)), 6: ((0, 1, 2, 3), (0, 1, 3, 4)), 7: ((0, 1, 3, 4),),
    8: ((0, 1, 2, 4, 5), (0, 1, 3, 4, 5)), 9: ((0, 1, 2, 3, 5, 6), (0, 1, 3, 4, 5, 6)),
    10: ((0, 1, 2, 4), (0, 1, 2, 3)), 11: ((0, 1, 3, 5, 6), (0, 1, 2, 5, 6)), 12: ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7)),
    13: ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))}
WINDOW = 13
NEEDED = 0.8
MIN_TOKENS = 5
BROADCAST_SEEDS = 500_000  # benchmark seeds (about 40 bytes each) and hit documents that may be broadcast


def tokens(text: Column) -> Column:
    """Hashes of the tokens of a text."""
    found = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(found, lambda t: F.xxhash64(t))


def _starts(h: Column, span: int) -> Column:
    return F.when(F.size(h) >= span, F.sequence(F.lit(0), F.size(h) - span)).otherwise(F.array().cast("array<int>"))


def _seeds(h: Column, masks: tuple[tuple[int, ...], ...]) -> list[Column]:
    """For every mask the seeds at all starts."""
    def one(k: int, mask: tuple[int, ...]) -> Column:
        return F.transform(_starts(h, mask[-1] + 1), lambda i: F.xxhash64(F.lit(1000 * mask[-1] + k), *[F.get(h, i + p) for p in mask]))
    return [one(k, mask) for k, mask in enumerate(masks)]


def _exploded(df: DataFrame, keep: list[str], tokens_column: str, masks) -> DataFrame:
    """keep, at, seed: one row per start and mask (one or two masks)."""
    every = let(F.col(tokens_column), lambda h: F.concat(*_seeds(h, masks)))
    rows = df.select(*keep, F.size(tokens_column).alias("n"), F.posexplode(every).alias("at", "seed"))
    for mask in masks[:-1]:  # seeds of later masks stand behind those of this one
        count = F.greatest(F.col("n") - mask[-1], F.lit(0))
        rows = rows.withColumn("at", F.when(F.col("at") >= count, F.col("at") - count).otherwise(F.col("at")))
    return rows.drop("n")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """``id, item, matched``: every benchmark item found in a document, with the most agreeing tokens on one alignment.

    Items that share an id are one item. Rows with a null key cannot be named and give no row. Other columns, whatever
    their names, are not read.
    """
    spark = docs.sparkSession
    docs = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    items = benchmark.select(F.col(item).alias("item"), tokens(F.col(item_text)).alias("want"))
    items = staged(items.where(F.size("want") >= MIN_TOKENS).distinct(), "items")
    length = F.least(F.size("want"), F.lit(WINDOW))
    lengths = [r[0] for r in items.select(length.alias("n")).distinct().collect()]  # from 5 to 13
    kinds = [(MASKS[n], items.where(length == n)) for n in sorted(lengths) or [WINDOW]]

    hits = None
    hashed = docs.select("id", tokens(F.col("text")).alias("have"))
    for masks, some in kinds:
        seeds = staged(_exploded(some, ["item", F.xxhash64("want").alias("version")], "want", masks)
                       .select("item", "version", F.col("at").alias("place"), "seed").distinct(), "seeds")
        few = seeds.count() <= BROADCAST_SEEDS
        found = _exploded(hashed, ["id"], "have", masks).join(F.broadcast(seeds) if few else seeds, "seed")
        found = found.select("id", "item", "version", (F.col("at") - F.col("place")).alias("shift"))
        hits = found if hits is None else hits.union(found)
    hits = staged(hits.distinct(), "hits")

    ids = staged(hits.select("id").distinct(), "hit_docs")
    few = ids.count() <= BROADCAST_SEEDS
    texts = docs.join(F.broadcast(ids) if few else ids, "id", "left_semi").select("id", tokens(F.col("text")).alias("have"))
    wanted = items.withColumn("version", F.xxhash64("want"))
    pairs = hits.join(wanted, ["item", "version"]).join(texts, "id")

    def agreeing(have: Column, want: Column) -> Column:
        return F.transform(want, lambda w, i: F.coalesce(w == F.get(have, F.col("shift") + i), F.lit(False)).cast("int"))

    def best(same: Column) -> Column:  # of all windows
        sums = F.transform(F.sequence(F.lit(0), F.size(same) - F.least(F.size(same), F.lit(WINDOW))),
                           lambda i: F.aggregate(F.slice(same, i + 1, WINDOW), F.lit(0), lambda a, x: a + x))
        return F.array_max(sums)

    checked = pairs.select("id", "item", let(agreeing(F.col("have"), F.col("want")), lambda s: F.struct(
        best(s).alias("best"), F.size(s).alias("n"), F.aggregate(s, F.lit(0), lambda a, x: a + x).alias("matched"))).alias("v"))
    good = checked.where(F.col("v.best") >= F.ceil(F.least("v.n", F.lit(WINDOW)) * F.lit(NEEDED)))
    return good.groupBy("id", "item").agg(F.max("v.matched").cast("long").alias("matched"))


def decontamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``contaminated``, ``items`` (ids of leaking items, ascending)."""
    found = leaks(docs, benchmark, key, text)
    per_doc = found.groupBy("id").agg(F.sort_array(F.collect_set("item")).alias("items"))
    ids = docs.select(F.col(key).alias("id"))
    return ids.join(per_doc, "id", "left").select(
        F.col("id").alias(key), F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast(per_doc.schema["items"].dataType)).alias("items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without a leak, all their columns; rows with a null key stay."""
    mark = fresh_name(docs, "gone")
    gone = staged(leaks(docs, benchmark, key, text).select(F.col("id").alias(mark)).distinct(), "gone")
    few = gone.count() <= BROADCAST_SEEDS
    return docs.join(F.broadcast(gone) if few else gone, docs[key] == F.col(mark), "left_anti")
