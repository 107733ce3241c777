"""The registered queries of this subpackage. Each reads whole tables and calls one operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import pitman_yor, warc
from leadloom.llm.chunk_dedup import repeats
from leadloom.llm.conversation_repair import repair_damaged
from leadloom.llm.decontam import decontamination
from leadloom.llm.merkle import document_manifest
from leadloom.llm.ngram_join import jaccard_components
from leadloom.llm.packing import pack
from leadloom.llm.pii import replace_pii
from leadloom.llm.quality import quality
from leadloom.llm.token_counts import token_counts
from leadloom.llm.toxicity import toxicity
from leadloom.llm.url_filters import filter_urls, host_of, path_of
from leadloom.session import shared_dir

PII_KEY = "leadloom-registered-query"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                "base_failed", "kept")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"))


def op3_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.score(_table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    warc.write_warc(_table(spark, folder, "pages"), path)
    page = r"^<urn:page:(-?[0-9]+)>$"
    records = warc.read_warc(spark, path).where(F.col("record_type").isin("response", "revisit"))
    whole = F.col("record_type") == "response"
    return records.select(
        F.regexp_extract("record_id", page, 1).cast("long").alias("page_id"),
        F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(whole, warc.base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", F.when(F.col("refers_to").isNotNull(), F.regexp_extract("refers_to", page, 1).cast("long")).alias("refers_to"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


def op7_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats(_table(spark, folder, "documents"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures: a page was fetched on day ``page_id mod 365`` of 2024."""
    return pages.select("page_id", "url", F.expr("date_add(DATE'2024-01-01', cast(page_id % 365 AS int))").alias("fetched_on"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list of the hosts in ``pages``: per host an entry for it or for its parent domain, one for a path, and removals.
    What an entry says is taken from the host's MD5."""
    hosts = pages.select(host_of(F.col("url")).alias("host"), F.get(F.split(path_of(F.col("url")), "/"), F.lit(1)).alias("top"))
    hosts = hosts.where("host IS NOT NULL").groupBy("host").agg(F.max("top").alias("top")).withColumn("h", F.md5("host"))

    def digits(a: int, n: int):
        return F.conv(F.substring("h", a, n), 16, 10).cast("int")

    start = F.expr("DATE'2023-10-01'")
    pattern = F.when(digits(1, 1) < 8, F.col("host")).otherwise(F.concat(F.lit("."), F.substring_index("host", ".", -2)))
    action = F.when(digits(2, 1) < 11, F.lit("block")).otherwise(F.lit("allow"))
    category = F.concat(F.lit("c"), (digits(3, 1) % 5).cast("string"))
    own = hosts.select(pattern.alias("pattern"), F.date_add(start, digits(4, 3) % 300).alias("listed_on"), action.alias("action"), category.alias("category"))
    gone = hosts.where(digits(7, 1) < 6).select(pattern.alias("pattern"), F.date_add(start, digits(4, 3) % 300 + 20 + digits(8, 2)).alias("listed_on"),
                                                F.lit("remove").alias("action"), category.alias("category"))
    part = hosts.where("top <> ''").select(F.concat("host", F.lit("/"), "top", F.lit("/")).alias("pattern"),
                                           F.date_add(start, digits(10, 3) % 400).alias("listed_on"),
                                           F.when(digits(13, 1) < 8, F.lit("block")).otherwise(F.lit("allow")).alias("action"), F.lit("path").alias("category"))
    return own.unionByName(gone).unionByName(part)


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return filter_urls(captures_of(pages), entries_of(pages))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_table(spark, folder, "documents"), words=3, percent=90)


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return replace_pii(docs, PII_KEY, values="found").selectExpr("doc_id", "text", "cast(size(found) as long) AS n_found")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair_damaged(_table(spark, folder, "conversations"))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return document_manifest(_table(spark, folder, "documents"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality, op2_packing, op3_pitman_yor, op4_toxicity, op5_warc, op6_decontamination, op7_chunk_dedup,
                            op8_url_filters, op9_jaccard_join, op10_pii, op11_conversation_repair, op12_merkle, op13_token_counts, pipeline)}
