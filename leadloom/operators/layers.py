"""Landed documents to flat tables, and the one parametrised feed job (bronze, silver, gold)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.ids import hash_key
from leadloom.functions.rank import best_row
from leadloom.functions.skew import grid_join
from leadloom.functions.values import norm
from leadloom.operators.merge import CREATED, KEPT_ON_UPDATE, audit_columns, gold_upsert, keyed_merge
from leadloom.session import staged

Fields = Mapping[str, tuple[str, str]]
"""Output column -> (source path, type)."""


def _fields(fields: Fields, prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}{path}").cast(dtype).alias(out) for out, (path, dtype) in fields.items()]


def flatten_struct(df: DataFrame, fields: Fields) -> DataFrame:
    """Dotted struct fields as columns; the number of rows stays."""
    return df.select(*_fields(fields))


def flatten_array(df: DataFrame, array: str, fields: Fields, envelope: Fields | None = None) -> DataFrame:
    """One row per element of an array, with envelope fields beside it; empty arrays give no row."""
    rows = df.select(*_fields(envelope or {}), F.explode(array).alias("_e"))
    return rows.select(*(envelope or {}), *_fields(fields, "_e."))


def flatten_nested_array(df: DataFrame, outer: str, inner: str, fields: Fields, outer_fields: Fields | None = None,
                         envelope: Fields | None = None) -> DataFrame:
    """One row per element of an array inside the elements of an array."""
    envelope, outer_fields = envelope or {}, outer_fields or {}
    rows = df.select(*_fields(envelope), F.explode(outer).alias("_o"))
    rows = rows.select(*envelope, *_fields(outer_fields, "_o."), F.explode(f"_o.{inner}").alias("_i"))
    return rows.select(*envelope, *outer_fields, *_fields(fields, "_i."))


def json_side_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nested columns kept beside the flat ones as JSON text."""
    return df.withColumns({c: F.to_json(c) for c in columns})


def explode_topics_or_self(df: DataFrame, topics: str = "topics") -> DataFrame:
    """One row per topic; a row without topics stands for itself through its own topic and score."""
    itself = F.array(F.struct(F.col("topic").alias("topic"), F.col("score").alias("score")))
    listed = F.when(F.size(topics) > 0, F.col(topics)).otherwise(itself)
    rest = [c for c in df.columns if c not in (topics, "topic", "score")]
    return df.select(*rest, F.explode(listed).alias("_t")).select(*rest, "_t.topic", "_t.score")


def classification_rows(df: DataFrame) -> DataFrame:
    """Best code and first alternative of a classification response, keyed by the lower-cased request."""
    best, alt = F.col("mostSuitableHs"), F.try_element_at(F.col("dutiableHsCode"), F.lit(1))

    def part(source: Column, field: str) -> Column:
        return F.coalesce(source[field], F.lit(""))
    return df.select(
        hash_key("title", "description", "country", "direction", lower=True).alias("hash_key"),
        part(best, "hsCode").alias("most_suitable_hs_code"), part(best, "description").alias("most_suitable_hs_description"),
        part(alt, "hsCode").alias("dutiable_hs_code"), part(alt, "description").alias("dutiable_hs_description"))


def normalise_health(df: DataFrame) -> DataFrame:
    """Relationship health from a nested or a flat response: first non-empty spelling, 0 or '' else.

    Needs columns relationshipHealth, relationship (structs) and the flat ones; struct fields that
    a response lacks are null.
    """
    def pick(dtype: str, default, *names: str) -> Column:
        tries = []
        for name in names:
            nested = F.when(F.col("relationshipHealth").isNotNull(), F.col(f"relationshipHealth.{name}")).when(
                F.col("relationship").isNotNull(), F.col(f"relationship.{name}")).otherwise(F.col(name))
            tries.append(F.nullif(nested.cast("string"), F.lit("")).try_cast(dtype))
        if dtype != "string":
            tries = [F.nullif(t, F.lit(0).cast(dtype)) for t in tries]
        return F.coalesce(*tries, F.lit(default).cast(dtype))
    return df.select(
        pick("string", "", "buyerId", "buyer_id").alias("buyer_id"),
        pick("string", "", "supplierId", "supplier_id").alias("supplier_id"),
        pick("double", 0.0, "healthScore", "health_score").alias("health_score"),
        pick("long", 0, "shipmentCount", "shipment_count").alias("shipment_count"),
        pick("string", "unknown", "healthStatus", "status").alias("health_status"))


def list_to_text(items: Column | str, field: str | None = None) -> Column:
    """Comma text of a list, or of one field of a list of structs; nulls are left out."""
    c = F.col(items) if isinstance(items, str) else items
    return F.array_join(F.transform(c, lambda x: (x[field] if field else x).cast("string")), ",")


def first_of_list(items: Column | str) -> Column:
    return F.try_element_at(F.col(items) if isinstance(items, str) else items, F.lit(1))


def family_tree_edges(edges: DataFrame, root_parent: int = 0, max_depth: int = 50) -> DataFrame:
    """Rows (root, node, parent, level, node_type) from (node, parent) edges, level by level.

    The loop stops at the first empty level. Each level is written out before the next, so the
    plan does not grow. A node reached again (a cycle) is not followed: visited nodes are removed
    by an anti-join.
    """
    pairs = edges.select(F.col("node").cast("long").alias("node"), F.col("parent").cast("long").alias("parent"),
                         "name").where("node is not null").distinct()
    pairs = staged(best_row(pairs, ["node"], [-F.col("parent")]), "edges")
    level = pairs.where(F.col("parent") == root_parent).select(
        F.col("node").alias("root"), "node", "parent", "name", F.lit(0).cast("long").alias("level"))
    done, depth = None, 0
    while True:
        level = staged(level, f"level_{depth}")
        if level.isEmpty():
            break
        done = level if done is None else done.unionByName(level)
        depth += 1
        if depth > max_depth:
            raise ValueError(f"tree deeper than {max_depth}")
        step = level.select("root", F.col("node").alias("parent")).join(pairs, "parent").select(
            "root", "node", "parent", "name", F.lit(depth).cast("long").alias("level"))
        level = step.join(done.select("node"), "node", "left_anti").select(*done.columns)
    done = level if done is None else done
    return done.withColumn("node_type", F.when(F.col("level") == 0, "root").otherwise("subsidiary"))


NODE_SCHEMA = "array<struct<companyId: long, companyName: string, city: string, familyNodes: string>>"


def family_tree_rows(docs: DataFrame, max_depth: int = 50) -> DataFrame:
    """Nested company trees (columns company_id, parent_id, parent_name, family_nodes as JSON text) as rows.

    Each turn parses one level and keeps the children as JSON text, so any depth works with a
    fixed schema; the loop ends at the first empty level. The document's own parentage is level -1.
    """
    root = F.col("company_id").cast("long").alias("root")
    above = docs.where(F.col("parent_id").isNotNull()).select(
        root, F.col("company_id").cast("long").alias("node"), F.col("parent_id").cast("long").alias("parent"),
        F.lit(-1).cast("long").alias("level"), F.lit("parentage").alias("node_type"),
        F.coalesce("parent_name", F.lit("")).alias("name"))
    level = docs.select(root, F.lit(0).cast("long").alias("parent"), F.col("family_nodes").alias("json"))
    done, depth = above, 0
    while depth <= max_depth:
        nodes = level.select("root", "parent", F.explode(F.from_json("json", NODE_SCHEMA)).alias("n"))
        nodes = staged(nodes.select(
            "root", F.coalesce("n.companyId", F.lit(0)).alias("node"), "parent", F.lit(depth).cast("long").alias("level"),
            F.when(F.lit(depth) == 0, "root").when(F.col("parent") == 0, "parent").otherwise("subsidiary").alias("node_type"),
            F.coalesce("n.companyName", F.lit("")).alias("name"), F.col("n.familyNodes").alias("json")), f"tree_{depth}")
        if nodes.isEmpty():
            return done
        done = done.unionByName(nodes.drop("json"))
        level = nodes.where("json is not null").select("root", F.col("node").alias("parent"), "json")
        depth += 1
    raise ValueError(f"tree deeper than {max_depth}")


def pairs_from_roles(companies: DataFrame, codes: DataFrame) -> DataFrame:
    """Distinct buyer and supplier pairs worth asking a health report for: those that share a code.

    Pairing every buyer with every supplier does not scale and mostly asks about strangers. How many
    buyers and suppliers a code has decides into how many parts it is cut (``grid_join``).
    """
    who = companies.select("company_id", norm("company_role").alias("role")).distinct()
    listed = staged(codes.select("company_id", "hs_code").distinct().join(who, "company_id"), "listed")
    buyers = listed.where("role = 'buyer'").select(F.col("company_id").alias("buyer_id"), "hs_code")
    suppliers = listed.where("role = 'supplier'").select(F.col("company_id").alias("supplier_id"), "hs_code")
    return grid_join(buyers, suppliers, ["hs_code"]).where("buyer_id <> supplier_id").select("buyer_id", "supplier_id").distinct()


def not_yet_enriched(contacts: DataFrame, enriched: DataFrame, min_score: float) -> DataFrame:
    """Contacts without an enrichment row whose accuracy is unknown or high enough."""
    score = F.col("contact_accuracy_score")
    return contacts.where(score.isNull() | (score >= min_score)).join(
        enriched.select("contact_id"), "contact_id", "left_anti")


@dataclass(frozen=True)
class Feed:
    """One feed: its silver key (hashed when ``hash_parts``), which duplicate wins, its gold key, and whether a row that comes
    again keeps the time it was first ingested, in silver and in gold."""

    key: tuple[str, ...]
    best: str
    gold_key: str
    gold_order: tuple[str, ...]
    hash_parts: tuple[str, ...] = ()
    update_gold: bool = True
    silver_keeps_time: bool = False
    gold_keeps_time: bool = True


# Keys and order of the 13 feeds.
FEEDS = {
    "buyer_supplier_list": Feed(("hash_key",), "number_of_shipments", "bsl_key", ("hash_key",),
                                ("company_id", "country", "zip_code", "matched_hs_codes", "company_role"), silver_keeps_time=True),
    "company_matcher": Feed(("company_id",), "name_match_percentage", "cm_key", ("company_id",), silver_keeps_time=True),
    "company_profile": Feed(("company_id",), "ingested_at", "cp_key", ("company_id",)),
    "hs_classifier": Feed(("hs_hash",), "ingested_at", "hs_key", ("hs_hash",),
                          ("product_title", "country_of_classification", "trade_direction")),
    "relationship_health": Feed(("supplier_id", "buyer_id"), "ingested_at", "rh_key", ("supplier_id", "buyer_id")),
    "shipment_search": Feed(("shipment_id",), "ingested_at", "shipment_key", ("shipment_id",)),
    "company_search": Feed(("company_id",), "ingested_at", "company_search_key", ("company_id",)),
    "contact_enrich": Feed(("person_id",), "ingested_at", "contact_key", ("person_id",), gold_keeps_time=False),
    "contact_search": Feed(("contact_id",), "last_updated_date", "contact_search_key",
                           ("last_updated_date", "contact_id")),
    "corporate_hierarchy": Feed(("company_id",), "ingested_at", "ch_key", ("company_id",)),
    "intent_search": Feed(("intent_hash",), "ingested_at", "intent_key", ("intent_hash",),
                          ("company_id", "topic", "signal_date")),
    "news_search": Feed(("news_id",), "ingested_at", "ns_key", ("news_id",)),
    "scoop_search": Feed(("scoop_id",), "ingested_at", "sc_key", ("scoop_id",)),
}


def dedup_best(df: DataFrame, keys: Sequence[str], best: str) -> DataFrame:
    """One row per key, the largest ``best`` value; all other columns break ties."""
    return best_row(df, list(keys), [F.col(best)])


def silver(bronze: DataFrame, old: DataFrame | None, feed: Feed, as_of, by: str) -> DataFrame:
    """Bronze rows hashed, reduced to one per key, with audit columns, merged into the old silver table."""
    rows = bronze
    if feed.hash_parts:
        rows = rows.withColumn(feed.key[0], hash_key(*feed.hash_parts))
    rows = audit_columns(dedup_best(rows, feed.key, feed.best), as_of, by)
    keep = KEPT_ON_UPDATE if feed.silver_keeps_time else CREATED
    return rows if old is None else keyed_merge(old, rows, feed.key, as_of=as_of, by=by, keep=keep)


def gold(silver_rows: DataFrame, old: DataFrame, feed: Feed) -> DataFrame:
    """The silver table with stable surrogate keys, on top of the old gold table (which may be empty)."""
    order = list(dict.fromkeys((*feed.gold_order, *feed.key)))
    keep = KEPT_ON_UPDATE if feed.gold_keeps_time else CREATED
    return gold_upsert(old, silver_rows, feed.gold_key, feed.key, order, update=feed.update_gold, keep=keep)
