"""Registered queries: every feed from landed JSON files to gold and warehouse, in two runs.

The records are made of the customers, at most some hundred per file: as one document that lists them or, where a document is
a record, as an array of documents. The second run brings some again, changed, and some new.
"""

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.checks.queries_views import work_dir
from leadloom.checks.registry import Registry
from leadloom.operators.layers import FEEDS
from leadloom.sources import feeds

RUNS = {1: "2024-01-30 00:00:00", 2: "2024-01-31 00:00:00"}
RECORDS = 500  # of a file, about; files grow in number, not in size
SHOWN = {"boolean": "", "long": ":s", "int": ":s", "double": ":d", "time": "", "vendor_time": "", "list": "", "json": "", "text": ""}


def _put(tree: dict, path: tuple[str, ...], value) -> None:
    for part in path[:-1]:
        tree = tree.setdefault(part, {})
    tree[path[-1]] = value


def _struct(tree: dict) -> Column:
    return F.struct(*[(_struct(v) if isinstance(v, dict) else v).alias(k) for k, v in tree.items()])


def _written(field: feeds.Field) -> Column:
    c = F.col(field.name)
    if field.kind == "vendor_time":
        return F.date_format(c, feeds.VENDOR_TIME)
    if field.kind == "json":
        return F.from_json(c, "struct<a: long>")
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") if field.kind == "time" else c


def documents(flat: DataFrame, name: str) -> DataFrame:
    """Flat records as the texts of files, several lines each. The records of a page go into one document, or into several once
    they are more than ``RECORDS``; all tell the same of the page. Records without a list around them are documents of their own."""
    feed = feeds.MAPS[name]
    levels: list[dict] = [{} for _ in range(len(feed.lists) + 1)]
    for field in feeds.fields_of(feed):
        _put(levels[field.level], field.path, F.first(_written(field)) if field.level == 0 and feed.lists else _written(field))
    together = ["page"] if feed.lists else []
    most = flat.groupBy(*together).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, ceil(most / RECORDS))))
    cut = flat.withColumn("_part", part).groupBy(*together, "_part")
    if not feed.lists:
        texts = F.collect_list(F.to_json(_struct(levels[0]), {"pretty": "true"}))
        return cut.agg(F.concat(F.lit("["), F.array_join(texts, ",\n"), F.lit("]")).alias("value"))
    inner = _struct(levels[-1])
    if len(feed.lists) == 2:  # one record in each element of the outer list
        _put(levels[1], tuple(feed.lists[1].split(".")), F.array(inner))
        inner = _struct(levels[1])
    _put(levels[0], tuple(feed.lists[0].split(".")), F.collect_list(inner))
    return cut.agg(F.to_json(_struct(levels[0]), {"pretty": "true"}).alias("value"))


def landed(i, name: str) -> str:
    """The files of both runs."""
    folder = f"{work_dir(i)}/{name}"
    flat = i[f"flat_{name}"]
    for run in RUNS:
        part = documents(flat.where(F.col("run") == run), name).select("value")
        path = f"{folder}/run{run}"
        if feeds.MAPS[name].path_facts:
            path += "/buyer-supplier-list/buyer/2024-01-01_to_2024-01-31"
        part.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
    return folder


def gold_of(i, name: str) -> DataFrame:
    folder, silver, gold = landed(i, name), None, None
    for run, as_of in RUNS.items():
        silver, gold = feeds.run_feed(i.spark, f"{folder}/run{run}", name, as_of, "feed", silver, gold)
    return feeds.warehouse_rows(gold, name)


def appended(i, name: str) -> DataFrame:
    """What the second run adds to the warehouse."""
    folder = landed(i, name)
    silver, first = feeds.run_feed(i.spark, f"{folder}/run1", name, RUNS[1], "feed")
    _, second = feeds.run_feed(i.spark, f"{folder}/run2", name, RUNS[2], "feed", silver, first)
    return feeds.warehouse_rows(second, name, feeds.warehouse_rows(first, name))


def columns(name: str) -> str:
    spec, feed = FEEDS[name], feeds.MAPS[name]
    own = [f"{f.name}{SHOWN[f.kind]}" for f in feeds.fields_of(feed) if f.name != "ingested_at"]
    facts = ["company_role", "from_date:s", "to_date:s"] if feed.path_facts else []
    hashed = [spec.key[0]] if spec.hash_parts else []
    return ",".join([f"{spec.gold_key}:i", *hashed, *own, *facts, "ingested_at", "created_on", "modified_on"])


def register(r: Registry) -> None:
    for name in feeds.MAPS:
        r.add(f"feed_{name}", lambda i, n=name: gold_of(i, n), columns(name))
    r.add("feed_warehouse_append", lambda i: appended(i, "buyer_supplier_list"), columns("buyer_supplier_list"))

