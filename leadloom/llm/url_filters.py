"""URL filters as a temporal list join.

List entries are dated: from ``listed_on`` an entry blocks, allows or (action ``remove``) stops doing so. The entries of a
pattern become validity intervals, and a capture meets the interval that holds at its fetch time. Patterns are a host,
a domain with all hosts below it (``.example.com``), or a host with a path prefix that ends in ``/``; hosts ignore case,
paths do not. Of the patterns active at
fetch time the most specific decides (longest pattern, then the last in order), so an allowed host may lie in a blocked domain.

The join is an equi join on (pattern, month): a capture has one key per domain level and path level of its URL, an interval
one row per month that holds captures, so a long history is not scanned and a hot host is an ordinary skewed join that
Spark splits. Captures travel as ids and hashes, not as pages. All native.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.session import staged

BROADCAST_ROWS = 200_000  # interval rows (about 80 bytes) that may be broadcast


def host_of(url: Column) -> Column:
    """The host in lower case without user and port; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(found != "", F.regexp_replace(found, r"\.$", ""))


def path_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(found == "", F.lit("/")).otherwise(found)


def patterns_of(host: Column, path: Column) -> Column:
    """All patterns that cover a URL."""
    labels = F.split(host, r"\.")
    below = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("."), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    parts = F.split(path, "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.concat(
        host, F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")))
    return F.array_distinct(F.concat(F.array(host), below, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, listed_on, until (null: still), category, action of every entry that blocks or allows.

    Entries with a null pattern, date or action say nothing. Of entries of a pattern and date the last one by
    (action, category) counts; equal ones are one.
    """
    dated = entries.where("pattern IS NOT NULL AND listed_on IS NOT NULL AND action IS NOT NULL")
    host = F.substring_index("pattern", "/", 1)
    pattern = F.concat(F.lower(host), F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)"))
    last = dated.groupBy(pattern.alias("pattern"), F.col("listed_on").cast("date").alias("listed_on")).agg(
        F.max(F.struct("action", "category")).alias("e"))
    history = Window.partitionBy("pattern").orderBy("listed_on")  # one pattern's own history
    spans = last.select("pattern", "listed_on", F.lead("listed_on").over(history).alias("until"),
                        F.col("e.category").alias("category"), F.col("e.action").alias("action"))
    return spans.where("action IN ('block', 'allow')")


def filter_urls(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url",
                fetched: str = "fetched_on") -> DataFrame:
    """One row per capture: key, host, fetched_on, blocked, pattern, category and listed_on of the deciding entry.

    A capture without a readable host, without a date or without an active entry is not blocked and names no entry. Rows
    that repeat a key are judged each on their own. ``entries``: pattern, listed_on, action (block, allow, remove), category.
    """
    plain = captures.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), F.col(fetched).cast("date").alias("day"))
    plain = plain.withColumn("host", host_of(F.col("url")))
    low, high = plain.agg(F.min(F.trunc("day", "month")), F.max(F.trunc("day", "month"))).first()
    first = F.greatest(F.trunc("listed_on", "month"), F.lit(low).cast("date"))
    last = F.least(F.trunc(F.date_sub(F.coalesce("until", F.lit("9999-12-31").cast("date")), 1), "month"), F.lit(high).cast("date"))
    monthly = intervals(entries).where((first <= last) & F.lit(low is not None)).select(
        "pattern", "listed_on", "until", "category", "action",
        F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month"))
    monthly = staged(monthly, "intervals")
    few = monthly.count() <= BROADCAST_ROWS
    patterns = F.when(F.col("host").isNotNull(), patterns_of(F.col("host"), path_of(F.col("url"))))
    asked = plain.where("day IS NOT NULL").select("host", "day", "url", F.trunc("day", "month").alias("month"),
                                                  F.explode(patterns).alias("pattern"))
    link = [F.xxhash64("url").alias("u"), F.hash("url").alias("v")]  # 96 bits instead of the URL
    asked = asked.select(*link, "day", "month", "pattern").distinct()
    met = asked.join(F.broadcast(monthly) if few else monthly, ["pattern", "month"]).where(
        "listed_on <= day AND (until IS NULL OR day < until)")
    best = met.groupBy("u", "v", "day").agg(F.max(F.struct(F.length("pattern").alias("size"), "pattern", "action", "category", "listed_on")).alias("b"))
    out = plain.select("*", *link).join(best, ["u", "v", "day"], "left")
    return out.select(F.col("id").alias(key), "host", F.col("day").alias(fetched),
                      F.coalesce(F.col("b.action") == "block", F.lit(False)).alias("blocked"),
                      F.col("b.pattern").alias("pattern"), F.col("b.category").alias("category"),
                      F.col("b.listed_on").alias("listed_on"))
