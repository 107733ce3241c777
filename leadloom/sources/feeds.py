"""The 13 vendor feeds from landed JSON documents to the warehouse: what each field is called on both sides, as data.

A feed's documents are JSON objects, one per file or several in an array, with the records in a list (or a list in a list) or as
the object itself. A map names the columns; a column comes from the record's field of the same name in camel case unless its path is given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.functions.values import as_ts
from leadloom.operators.layers import FEEDS, gold, silver
from leadloom.session import staged
from leadloom.sources.landed import path_fields, read_landed_json
from leadloom.sources.sinks import append_new_keys, warehouse_shape

VENDOR_TIME = "M/d/yyyy h:mm a"


@dataclass(frozen=True)
class FeedMap:
    """``lists``: the lists from the document down to the records, each within an element of the one before. ``columns``:
    ``name[:kind][=path]`` separated by blanks; a path is relative to the record, to the document (``/``) or to the element
    around the record (``..``). Kinds: text (default), long, double, int, boolean, time, vendor_time, list, json (its text without blanks,
    keys in order)."""

    lists: tuple[str, ...]
    columns: str
    path_facts: bool = False


# Lists and columns of the feeds.
MAPS = {
    "buyer_supplier_list": FeedMap(("companies",), (
        "company_id company_name country state city zip_code address=addressList number_of_shipments:long shipment_value:double "
        "trading_partner_count:long matched_hs_codes:list stock_tickers:list matched_product_keyword:list matched_countries_trading_with:list"), True),
    "company_matcher": FeedMap(("companies",), (
        "company_id company_name country name_match_percentage:double total_shipment_count:long company_address=company_address")),
    "company_profile": FeedMap((), (
        "company_id=companyID company_name country state city zip_code address=addressList phone website company_type "
        "total_shipment_count:long total_import_count:long total_export_count:long trading_partner_count:long trade_health_score:double "
        "supplier_risk_score:double import_volume:double export_volume:double stock_tickers_json:json top_trading_partners_json:json")),
    "hs_classifier": FeedMap((), (
        "ingested_at:time=ingested_at product_title=request.product_title product_description=request.product_description "
        "country_of_classification=request.country_of_classification trade_direction=request.trade_direction sku_id=request.sku_id "
        "status=response.status most_suitable_hs_code=response.mostSuitableHs.hsCode most_suitable_description=response.mostSuitableHs.description "
        "dutiable_hs_codes_json:json=response.dutiableHsCode")),
    "relationship_health": FeedMap((), (
        "ingested_at:time=ingested_at supplier_id=request.supplier_id buyer_id=request.buyer_id trade_from_date=request.from_date "
        "trade_to_date=request.to_date supplier_name=response.supplierName supplier_country=response.supplierCountryName "
        "buyer_name=response.buyerName buyer_country=response.buyerCountryName trade_relationship_health:double=response.tradeRelationshipHealth "
        "total_shipment_count:long=response.totalShipmentCount shipment_trend=response.shipmentTrend last_shipment_date=response.lastShipmentDate")),
    "shipment_search": FeedMap(("shipments",), (
        "shipment_id shipment_date shipper_name shipper_id shipper_country_name shipper_address consignee_name consignee_id "
        "consignee_country_name consignee_address port_of_lading port_of_unlading hs_codes_json:json product_description quantity:double "
        "quantity_unit weight:double weight_unit value:double value_currency bill_of_lading_number")),
    "company_search": FeedMap(("data",), (
        "company_id=id company_name=name website ticker phone revenue:double employee_count:long company_type city state country continent "
        "street zip_code naics_code sic_code industry_keywords_json:json hashtags_json:json founded is_defunct:boolean ingested_at:time=/ingested_at")),
    "contact_enrich": FeedMap(("data.result", "data"), (
        "id:long person_id:long=..input.personid mobile_phone phone email mobile_dnc:boolean=mobilePhoneDoNotCall "
        "direct_dnc:boolean=directPhoneDoNotCall company_id:long=company.id")),
    "contact_search": FeedMap(("data",), (
        "contact_id:long=id first_name middle_name last_name job_title contact_accuracy_score:int valid_date:vendor_time "
        "last_updated_date:vendor_time has_email:boolean has_supplemental_email:boolean has_direct_phone:boolean has_mobile_phone:boolean "
        "has_company_industry:boolean has_company_phone:boolean has_company_street:boolean has_company_state:boolean "
        "has_company_zip_code:boolean has_company_country:boolean has_company_revenue:boolean has_company_employee_count:boolean "
        "direct_phone_do_not_call:boolean mobile_phone_do_not_call:boolean company_id:long=company.id company_name=company.name ingested_at:time=/ingested_at")),
    "corporate_hierarchy": FeedMap(("response.data.result",), (
        "ingested_at:time=/ingested_at query_company_name=/match_input.companyName query_company_id=/match_input.companyId company_id:long=data.companyId "
        "parent_company_id:long=data.parentage.parentCompany.id parent_company_name=data.parentage.parentCompany.name "
        "parent_country=data.parentage.parentCompany.country ultimate_parent_id:long=data.parentage.ultimateParentCompany.id "
        "ultimate_parent_name=data.parentage.ultimateParentCompany.name ultimate_parent_country=data.parentage.ultimateParentCompany.country "
        "family_tree_json:json=data.familyTree")),
    "intent_search": FeedMap(("data",), (
        "company_id company_name topic signal_score:double audience_strength signal_date country state city employee_count:long revenue:double "
        "website ingested_at:time=/ingested_at")),
    "news_search": FeedMap(("data",), (
        "ingested_at:time=/ingested_at page_date_min=/pageDateMin page_date_max=/pageDateMax news_id:long=id title news_url=url category "
        "published_date company_id:long company_name domain")),
    "scoop_search": FeedMap(("data",), (
        "ingested_at:time=/ingested_at scoop_id:long=id scoop_title scoop_summary scoop_type scoop_topic company_id:long company_name "
        "published_date scoop_url scoop_source")),
}


@dataclass(frozen=True)
class Field:
    """A column, its kind, and where it lies: ``level`` 0 is the document, 1 an element of the first list, and so on."""

    name: str
    kind: str
    level: int
    path: tuple[str, ...]


def fields_of(feed: FeedMap) -> Iterator[Field]:
    for text in feed.columns.split():
        named, _, path = text.partition("=")
        name, _, kind = named.partition(":")
        level = len(feed.lists)
        if path.startswith("/"):
            level, path = 0, path[1:]
        elif path.startswith(".."):
            level, path = level - 1, path[2:]
        if not path:
            first, *rest = name.removesuffix("_json").split("_")
            path = first + "".join(word.capitalize() for word in rest)
        yield Field(name, kind or "text", level, tuple(path.split(".")))


def schema_of(feed: FeedMap) -> T.StructType:
    """The schema to read documents with: named fields only, values as text, so nothing is inferred or fails to parse."""
    levels: list[dict] = [{} for _ in range(len(feed.lists) + 1)]

    def put(tree: dict, path: tuple[str, ...], value) -> None:
        for part in path[:-1]:
            tree = tree.setdefault(part, {})
        tree[path[-1]] = value

    def struct(tree: dict) -> T.StructType:
        return T.StructType([T.StructField(k, struct(v) if isinstance(v, dict) else v) for k, v in tree.items()])
    for field in fields_of(feed):
        put(levels[field.level], field.path, T.ArrayType(T.StringType()) if field.kind == "list" else T.StringType())
    for level in reversed(range(len(feed.lists))):
        put(levels[level], tuple(feed.lists[level].split(".")), T.ArrayType(struct(levels[level + 1])))
    return struct(levels[0])


def _value(field: Field, at: str) -> Column:
    raw = F.col(".".join([*([at] if at else []), *[f"`{p}`" for p in field.path]]))
    if field.kind == "time":
        return raw.try_cast("timestamp")
    if field.kind == "vendor_time":
        return F.try_to_timestamp(raw, F.lit(VENDOR_TIME))
    if field.kind == "json":
        return F.to_json(F.try_parse_json(raw))
    return raw if field.kind in ("text", "list") else raw.try_cast(field.kind)


def bronze(documents: DataFrame, feed: FeedMap, as_of) -> DataFrame:
    """One row per record. Documents without records give none; a value that is not of its kind is null. Records that carry no
    time of their own get that of the run."""
    rows = documents
    for level, path in enumerate(feed.lists, start=1):
        source = ".".join([*([f"_e{level - 1}"] if level > 1 else []), *[f"`{p}`" for p in path.split(".")]])
        rows = rows.withColumn(f"_e{level}", F.explode(source))
    picked = [_value(f, f"_e{f.level}" if f.level else "").alias(f.name) for f in fields_of(feed)]
    if feed.path_facts:
        rows = path_fields(rows)
        picked += [F.col(c) for c in ("company_role", "from_date", "to_date")]
    if not any(f.name == "ingested_at" for f in fields_of(feed)):
        picked.append(as_ts(as_of).alias("ingested_at"))
    return rows.select(*picked)


def read_feed(spark: SparkSession, folder: str, name: str, as_of) -> DataFrame:
    """The records of all documents below a folder."""
    return bronze(read_landed_json(spark, folder, schema_of(MAPS[name])), MAPS[name], as_of)


def run_feed(spark: SparkSession, folder: str, name: str, as_of, by: str, old_silver: DataFrame | None = None,
             old_gold: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(silver, gold) after the documents of a folder, on top of the tables of the run before. Records without a key are left out.
    Silver is written once, so the documents are read once, however often this run and later ones use it."""
    spec, rows = FEEDS[name], read_feed(spark, folder, name, as_of)
    needed = spec.hash_parts[:1] if spec.hash_parts else spec.key
    for column in needed:
        rows = rows.where(F.col(column).isNotNull())
    new_silver = staged(silver(rows, old_silver, spec, as_of, by), "silver")
    before = old_gold if old_gold is not None else new_silver.where("1 = 0").select(F.lit(0).cast("long").alias(spec.gold_key), "*")
    return new_silver, gold(new_silver, before, spec)


def warehouse_rows(gold_rows: DataFrame, name: str, target: DataFrame | None = None) -> DataFrame:
    """What the warehouse table lacks: gold rows in its form, lists as text, whose surrogate key it does not have."""
    lists = [f.name for f in fields_of(MAPS[name]) if f.kind == "list" and f.name != "stock_tickers"]
    rows = warehouse_shape(gold_rows, gold_rows.columns, arrays=lists, structs=[f.name for f in fields_of(MAPS[name]) if f.name == "stock_tickers"])
    return rows if target is None else append_new_keys(target, rows, FEEDS[name].gold_key)
