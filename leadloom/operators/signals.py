"""From any source row to a signal, and the registry of sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.config import SourcePrefixes
from leadloom.functions.ids import stable_id
from leadloom.functions.values import as_ts, choose, first_present, to_number

TRADE, THIRD, ENRICH = "TradeShipmentSource", "ThirdPartyIntelligenceSource", "EnrichmentSource"
WEB, CRM, IDENT = "WebsiteBehaviorSource", "CRMSource", "IdentitySource"

# Fixed values: (signal type, source family) by source table. {trade}, {firmo} and {app} stand for
# the deployment's own schema or table prefixes (config.SourcePrefixes).
SIGNAL_MAP = {
    "raw.{trade}_shipment_bl": ("shipment_detected", TRADE),
    "raw.{trade}_buyer_supplier_list": ("active_importer_detected", TRADE),
    "raw.{trade}_company_master": ("trade_company_profile_detected", TRADE),
    "raw.{trade}_company_matcher": ("trade_company_matched", TRADE),
    "raw.{trade}_company_import_partner": ("import_partner_detected", TRADE),
    "raw.{trade}_company_export_partner": ("export_partner_detected", TRADE),
    "raw.{trade}_company_imported_hs": ("import_hs_interest_detected", TRADE),
    "raw.{trade}_company_exported_hs": ("export_hs_activity_detected", TRADE),
    "raw.{trade}_company_imported_keyword": ("import_keyword_interest_detected", TRADE),
    "raw.{trade}_company_exported_keyword": ("export_keyword_activity_detected", TRADE),
    "raw.{trade}_company_country_import": ("import_country_activity_detected", TRADE),
    "raw.{trade}_company_country_export": ("export_country_activity_detected", TRADE),
    "raw.{trade}_company_ports_lading": ("export_port_activity_detected", TRADE),
    "raw.{trade}_company_ports_unlading": ("import_port_activity_detected", TRADE),
    "raw.{trade}_hs_classifier": ("hs_classification_detected", TRADE),
    "raw.{trade}_relationship_health": ("relationship_health_detected", TRADE),
    "raw.{trade}_company_profile": ("company_profile_detected", TRADE),
    "raw.{trade}_shipment_search": ("shipment_search_detected", TRADE),
    "raw.company_hs_code": ("company_hs_profile_detected", TRADE),
    "raw.company_products": ("company_product_profile_detected", TRADE),
    "{firmo}.company_search": ("company_discovered", THIRD),
    "{firmo}.contact_search": ("contact_discovered", THIRD),
    "{firmo}.contact_enrich": ("contact_enriched", ENRICH),
    "{firmo}.corporate_hierarchy": ("firmographic_update_detected", THIRD),
    "{firmo}.intent_search": ("third_party_intent_detected", THIRD),
    "{firmo}.news_search": ("news_trigger_detected", THIRD),
    "{firmo}.scoop_search": ("business_event_detected", THIRD),
    "skg.intent_signal": ("commercial_intent_detected", THIRD),
    "skg.intent_score": ("intent_score_updated", THIRD),
    "skg.interaction": ("interaction_detected", WEB),
    "skg.lead": ("external_lead_detected", CRM),
    "crm.click_tracking": ("commercial_click_detected", WEB),
    "crm.page_event_trackings": ("commercial_action_detected", WEB),
    "crm.page_visits": ("page_visit_detected", WEB),
    "crm.scroll_depths": ("scroll_depth_recorded", WEB),
    "crm.session_engagements": ("session_engagement_detected", WEB),
    "crm.rfqs": ("rfq_detected", CRM),
    "crm.rfq_items": ("rfq_item_detected", CRM),
    "crm.rfq_files": ("rfq_file_attached", CRM),
    "crm.rfq_distributions": ("rfq_distributed", CRM),
    "crm.rfq_quotes": ("quote_submitted", CRM),
    "crm.quotation": ("quote_request_detected", CRM),
    "crm.deals": ("deal_detected", CRM),
    "crm.deal_stages": ("deal_stage_changed", CRM),
    "crm.deal_stage_histories": ("deal_stage_history_recorded", CRM),
    "crm.crm_leads": ("crm_lead_detected", CRM),
    "crm.crm_contacts": ("contact_detected", CRM),
    "crm.crm_emails": ("email_interaction_detected", CRM),
    "crm.auto_quote_email_events": ("email_event_detected", CRM),
    "crm.crm_lead_product_items": ("lead_product_interest_detected", CRM),
    "crm.lead_master": ("lead_master_updated", CRM),
    "crm.lead_evidence": ("lead_evidence_recorded", CRM),
    "crm.raw_source_payload": ("raw_source_ingested", CRM),
    "crm.signal_registry": ("signal_registered", "NormalizedSource"),
    "crm.source_registry": ("source_registered", "NormalizedSource"),
    "crm.lead_action_log": ("lead_action_logged", CRM),
    "crm.lead_suppression_log": ("lead_suppressed", CRM),
    "crm.lead_distribution_log": ("lead_distributed", CRM),
    "crm.account_identity": ("identity_resolved", IDENT),
    "crm.account_risk_flags": ("compliance_flag_detected", "ComplianceSource"),
    "crm.identity_resolution_log": ("identity_resolution_logged", IDENT),
    "crm.account_state": ("account_state_changed", CRM),
    "crm.person_identity": ("person_identity_detected", IDENT),
    "crm.partner_registry": ("partner_detected", CRM),
    "crm.engagement_with_sellers": ("seller_engagement_detected", CRM),
    "crm.trade_relationship": ("crm_trade_relationship_detected", TRADE),
    "crm.scoring_outcomes": ("scoring_outcome_recorded", CRM),
    "crm.scoring_rule_evaluation": ("scoring_rule_evaluated", CRM),
    "crm.build_lead_score": ("lead_score_built", CRM),
    "crm.seller_user_metrics": ("seller_metric_updated", CRM),
    "{app}.messages": ("message_sent_detected", CRM),
    "{app}.bot_detection_logs": ("bot_detected", "BotDetectionSource"),
    "{app}_staging.enquiries": ("enquiry_detected", CRM),
    "{app}_staging.tracking_sessions": ("session_detected", WEB),
    "{app}_staging.tracking_click_events": ("click_detected", WEB),
    "{app}_staging.tracking_page_views": ("page_view_detected", WEB),
}
# Words in an unmapped table name, tried in this order.
SIGNAL_FALLBACKS = [
    (["{trade}", "shipment", "import", "export", "hs_code"], "trade_intelligence_detected", TRADE),
    (["{firmo}", "intent_search", "scoop"], "third_party_company_intelligence_detected", THIRD),
    (["click", "page_visit", "session", "scroll", "page_event"], "web_behavior_detected", WEB),
    (["rfq", "quotation", "deal", "lead", "contact", "email"], "crm_event_detected", CRM),
    (["intent"], "commercial_intent_detected", THIRD),
]
# Accepted column names, most wanted first.
RECORD_ID = ["id", "source_record_id", "uuid", "uid", "company_id", "companyid", "contact_id", "shipment_id",
             "identifier", "bl_id", "bsl_key"]
ACCOUNT = ["account_id", "company_id", "companyid", "organization_id", "org_id", "importer_id", "exporter_id",
           "company_name", "companyname", "consignee_name", "shipper_name", "domain"]
PERSON = ["person_id", "contact_id", "user_id", "email", "phone", "mobilephone"]
PRODUCT = ["product_id", "sku", "product_name", "hs_code", "hscode", "productdescription"]
CATEGORY = ["category_id", "category", "hs_code", "hscode", "industry"]
OCCURRED = ["occurred_at", "created_at", "updated_at", "timestamp", "event_time", "shipment_date", "date",
            "received_at", "modified_on", "created_on"]
CODE = ["hs_code", "hscode", "matched_hs_code"]
VALUE = ["shipment_value", "shipmentvalue", "total_value", "trade_value", "amount"]
SHIPMENTS = ["number_of_shipments", "totalshipments", "shipment_count", "shipments"]
FAMILY_CONFIDENCE = {TRADE: 0.90, ENRICH: 0.85}


def named(mapping: Mapping, prefixes: SourcePrefixes) -> dict:
    """The map with the deployment's prefixes filled in."""
    return {k.format(trade=prefixes.trade, firmo=prefixes.firmo, app=prefixes.app): v for k, v in mapping.items()}


def signal_type_of(tables: DataFrame, prefixes: SourcePrefixes = SourcePrefixes()) -> DataFrame:
    """Adds signal_type and source_family to rows with ``source_key`` (``schema.table``).

    Exact name first (broadcast join on a fixed 76-row map), then the first word rule that fits;
    tables nothing fits are dropped.
    """
    known = tables.sparkSession.createDataFrame(
        [(k, *v) for k, v in named(SIGNAL_MAP, prefixes).items()], "_key string, _type string, _family string")
    key = F.lower("source_key")
    rules = []
    for words, kind, family in SIGNAL_FALLBACKS:
        full = [w.format(trade=prefixes.trade, firmo=prefixes.firmo, app=prefixes.app) for w in words]
        hit = F.lit(False)
        for word in full:
            hit = hit | F.contains(key, F.lit(word))
        rules.append((hit, kind, family))
    joined = tables.join(F.broadcast(known), key == F.col("_key"), "left")
    typed = joined.select(
        *tables.columns,
        F.coalesce("_type", choose([(c, k) for c, k, _ in rules], None)).alias("signal_type"),
        F.coalesce("_family", choose([(c, f) for c, _, f in rules], None)).alias("source_family"))
    return typed.where(F.col("signal_type").isNotNull())


def confidence_of(family: Column) -> Column:
    return choose([(family == f, c) for f, c in FAMILY_CONFIDENCE.items()], 0.70)


def normalise_signals(rows: DataFrame, source_key: str, signal_type: str, family: str, as_of) -> DataFrame:
    """Rows of one source table as signals with stable ids, hints, numbers and a JSON payload."""
    as_json = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    key = F.lit(source_key.lower())
    record = F.coalesce(first_present(rows, RECORD_ID), stable_id(key, as_json))
    when = F.replace(first_present(rows, OCCURRED), F.lit(" "), F.lit("T"))
    now = F.date_format(as_ts(as_of), "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.lit(signal_type)
    loud = F.contains(kind, F.lit("shipment")) | F.contains(kind, F.lit("rfq"))
    picked = rows.select(
        key.alias("source_key"), record.alias("source_record_id"), F.coalesce(when, now).alias("occurred_at"),
        first_present(rows, ACCOUNT).alias("account_hint"), first_present(rows, PERSON).alias("person_hint"),
        first_present(rows, PRODUCT).alias("product_hint"), first_present(rows, CATEGORY).alias("category_hint"),
        first_present(rows, CODE).alias("hs_code"), to_number(first_present(rows, VALUE)).alias("shipment_value"),
        to_number(first_present(rows, SHIPMENTS)).alias("number_of_shipments"),
        as_json.alias("payload"))
    return picked.select(
        stable_id(F.lit("signal"), key, F.col("source_record_id"), kind).alias("signal_uid"),
        stable_id(F.lit("source_record"), key, F.col("source_record_id")).alias("raw_uid"),
        kind.alias("signal_type"), F.lit(family).alias("source_family"),
        confidence_of(F.lit(family)).alias("confidence_score"), F.when(loud, 1.0).otherwise(0.6).alias("intensity_score"),
        *picked.columns)


# Platform tables that make signals: (id column, signal type, source family).
PLATFORM_SIGNALS = {
    "PageView": ("pageViewId", "page_view", WEB),
    "RFQ": ("rfqId", "rfq_created", "RFQInquirySource"),
    "Lead": ("leadId", "lead_created", CRM),
    "Meeting": ("meetingId", "meeting_scheduled", CRM),
    "Deal": ("dealId", "deal_created", "CommercialProgressionSource"),
}


def derive_platform_signals(tables: Mapping[str, DataFrame], known: DataFrame, as_of) -> DataFrame:
    """Signals of platform rows (tables by label) that are not among ``known`` signal_uids yet."""
    now = F.date_format(as_ts(as_of), "yyyy-MM-dd'T'HH:mm:ss")
    out = None
    for label, frame in tables.items():
        id_col, kind, family = PLATFORM_SIGNALS[label]
        part = frame.where(F.col(id_col).isNotNull()).select(
            F.concat(F.lit(f"signal:derived:{label}:"), F.col(id_col).cast("string")).alias("signal_uid"),
            F.lit(f"derived.{label}").alias("source_key"), F.lit(kind).alias("signal_type"),
            F.lit(family).alias("source_family"),
            F.coalesce(first_present(frame, ["createdAt", "created_at", "eventTs"]), now).alias("occurred_at"),
            F.lit(0.75).alias("confidence_score"), F.lit(0.7).alias("intensity_score"),
            first_present(frame, ["accountId", "userId", "user_id"]).alias("account_hint"),
            first_present(frame, ["personId", "contactId", "contact_id"]).alias("person_hint"),
            first_present(frame, ["productId", "product_id"]).alias("product_hint"),
            first_present(frame, ["categoryId", "category_id"]).alias("category_hint"))
        out = part if out is None else out.unionByName(part)
    return out.join(known.select("signal_uid"), "signal_uid", "left_anti")


def source_registry(signals: DataFrame) -> DataFrame:
    """Edges of the source registry as (kind, src, dst): raw and signal to source, type and family."""
    raw = F.coalesce("raw_uid", "signal_uid")
    edges = F.array(
        F.struct(F.lit("RECORDED_IN_SOURCE").alias("kind"), raw.alias("src"), F.col("source_key").alias("dst")),
        F.struct(F.lit("NORMALIZES_TO").alias("kind"), raw.alias("src"), F.col("signal_uid").alias("dst")),
        F.struct(F.lit("FROM_SOURCE").alias("kind"), F.col("signal_uid").alias("src"), F.col("source_key").alias("dst")),
        F.struct(F.lit("HAS_TYPE").alias("kind"), F.col("signal_uid").alias("src"), F.col("signal_type").alias("dst")),
        F.struct(F.lit("BELONGS_TO").alias("kind"), F.col("signal_uid").alias("src"), F.col("source_family").alias("dst")))
    return signals.select(F.explode(edges).alias("e")).select("e.*").distinct()
