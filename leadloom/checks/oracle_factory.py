"""DuckDB statements for signals and the lead factory."""

from leadloom.checks.sqltext import quoted, rnd, sid, values_table

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
# Fixed values, written here again so that a wrong one in an operator shows: groups of signal and lead types, signals by source.
COMMITMENT_TYPES = ["quote_sent", "quote_opened", "quote_accepted", "po_received", "contract_signed", "deal_won"]
DEAL_TYPES = ["deal_created", "deal_stage_progressed"]
ENRICHMENT_TYPES = ["contact_enriched", "firmographic_update_detected", "company_discovered"]
EVENT_TYPES = ["meeting_scheduled", "event_attended"]
HIGH_TYPES = [
    "rfq_draft", "hot_in_market", "market_opportunity", "active_deal", "active_importer", "trade_buyer_candidate", "buying_committee_active"]
INTELLIGENCE_TYPES = ["meeting_scheduled", "contact_enriched", "third_party_intent_detected", "business_event_detected", "news_trigger_detected"]
LATE_STAGE = ["deal_ready", "quote_ready", "rfq_submitted", "strategic_consolidation"]
LOW_TYPES = ["visit_only", "cold_market", "intent_only"]
MEDIUM_TYPES = ["warm_account", "procurement_project_active", "strategic_account"]
OPEN_TYPES = ["lead_created", "deal_created", "deal_stage_progressed"]
QUEUE_GROUPS = [
    (["rfq_submitted", "deal_ready", "strategic_consolidation"], "immediate"),
    (["rfq_draft", "hot_in_market", "active_importer", "buying_committee_active", "quote_ready"], "priority_queue"),
    (["trade_buyer_candidate", "market_opportunity", "procurement_project_active", "active_deal", "strategic_account"], "standard_queue"),
]
RFQ_FIRST = ["rfq_submitted", "rfq_created", "rfq_started", "inquiry_created"]
RFQ_TYPES = [
    "rfq_created", "rfq_submitted", "rfq_started", "inquiry_created", "specification_uploaded", "drawing_uploaded", "bom_uploaded", "boq_uploaded"]
VISIBILITY_GROUPS = [
    (["blocked"], "internal_only"),
    (["rfq_submitted", "deal_ready"], "instant_alert"),
    (["hot_in_market", "quote_ready", "buying_committee_active"], "push_notify"),
    (["market_opportunity", "strategic_account", "active_deal", "active_importer", "trade_buyer_candidate", "strategic_consolidation"], "priority"),
]
_SIGNALS = [
    ("raw.trade_shipment_bl", "shipment_detected", "TradeShipmentSource"),
    ("raw.trade_buyer_supplier_list", "active_importer_detected", "TradeShipmentSource"),
    ("raw.trade_company_master", "trade_company_profile_detected", "TradeShipmentSource"),
    ("raw.trade_company_matcher", "trade_company_matched", "TradeShipmentSource"),
    ("raw.trade_company_import_partner", "import_partner_detected", "TradeShipmentSource"),
    ("raw.trade_company_export_partner", "export_partner_detected", "TradeShipmentSource"),
    ("raw.trade_company_imported_hs", "import_hs_interest_detected", "TradeShipmentSource"),
    ("raw.trade_company_exported_hs", "export_hs_activity_detected", "TradeShipmentSource"),
    ("raw.trade_company_imported_keyword", "import_keyword_interest_detected", "TradeShipmentSource"),
    ("raw.trade_company_exported_keyword", "export_keyword_activity_detected", "TradeShipmentSource"),
    ("raw.trade_company_country_import", "import_country_activity_detected", "TradeShipmentSource"),
    ("raw.trade_company_country_export", "export_country_activity_detected", "TradeShipmentSource"),
    ("raw.trade_company_ports_lading", "export_port_activity_detected", "TradeShipmentSource"),
    ("raw.trade_company_ports_unlading", "import_port_activity_detected", "TradeShipmentSource"),
    ("raw.trade_hs_classifier", "hs_classification_detected", "TradeShipmentSource"),
    ("raw.trade_relationship_health", "relationship_health_detected", "TradeShipmentSource"),
    ("raw.trade_company_profile", "company_profile_detected", "TradeShipmentSource"),
    ("raw.trade_shipment_search", "shipment_search_detected", "TradeShipmentSource"),
    ("raw.company_hs_code", "company_hs_profile_detected", "TradeShipmentSource"),
    ("raw.company_products", "company_product_profile_detected", "TradeShipmentSource"),
    ("firmo.company_search", "company_discovered", "ThirdPartyIntelligenceSource"),
    ("firmo.contact_search", "contact_discovered", "ThirdPartyIntelligenceSource"),
    ("firmo.contact_enrich", "contact_enriched", "EnrichmentSource"),
    ("firmo.corporate_hierarchy", "firmographic_update_detected", "ThirdPartyIntelligenceSource"),
    ("firmo.intent_search", "third_party_intent_detected", "ThirdPartyIntelligenceSource"),
    ("firmo.news_search", "news_trigger_detected", "ThirdPartyIntelligenceSource"),
    ("firmo.scoop_search", "business_event_detected", "ThirdPartyIntelligenceSource"),
    ("skg.intent_signal", "commercial_intent_detected", "ThirdPartyIntelligenceSource"),
    ("skg.intent_score", "intent_score_updated", "ThirdPartyIntelligenceSource"),
    ("skg.interaction", "interaction_detected", "WebsiteBehaviorSource"),
    ("skg.lead", "external_lead_detected", "CRMSource"),
    ("crm.click_tracking", "commercial_click_detected", "WebsiteBehaviorSource"),
    ("crm.page_event_trackings", "commercial_action_detected", "WebsiteBehaviorSource"),
    ("crm.page_visits", "page_visit_detected", "WebsiteBehaviorSource"),
    ("crm.scroll_depths", "scroll_depth_recorded", "WebsiteBehaviorSource"),
    ("crm.session_engagements", "session_engagement_detected", "WebsiteBehaviorSource"),
    ("crm.rfqs", "rfq_detected", "CRMSource"),
    ("crm.rfq_items", "rfq_item_detected", "CRMSource"),
    ("crm.rfq_files", "rfq_file_attached", "CRMSource"),
    ("crm.rfq_distributions", "rfq_distributed", "CRMSource"),
    ("crm.rfq_quotes", "quote_submitted", "CRMSource"),
    ("crm.quotation", "quote_request_detected", "CRMSource"),
    ("crm.deals", "deal_detected", "CRMSource"),
    ("crm.deal_stages", "deal_stage_changed", "CRMSource"),
    ("crm.deal_stage_histories", "deal_stage_history_recorded", "CRMSource"),
    ("crm.crm_leads", "crm_lead_detected", "CRMSource"),
    ("crm.crm_contacts", "contact_detected", "CRMSource"),
    ("crm.crm_emails", "email_interaction_detected", "CRMSource"),
    ("crm.auto_quote_email_events", "email_event_detected", "CRMSource"),
    ("crm.crm_lead_product_items", "lead_product_interest_detected", "CRMSource"),
    ("crm.lead_master", "lead_master_updated", "CRMSource"),
    ("crm.lead_evidence", "lead_evidence_recorded", "CRMSource"),
    ("crm.raw_source_payload", "raw_source_ingested", "CRMSource"),
    ("crm.signal_registry", "signal_registered", "NormalizedSource"),
    ("crm.source_registry", "source_registered", "NormalizedSource"),
    ("crm.lead_action_log", "lead_action_logged", "CRMSource"),
    ("crm.lead_suppression_log", "lead_suppressed", "CRMSource"),
    ("crm.lead_distribution_log", "lead_distributed", "CRMSource"),
    ("crm.account_identity", "identity_resolved", "IdentitySource"),
    ("crm.account_risk_flags", "compliance_flag_detected", "ComplianceSource"),
    ("crm.identity_resolution_log", "identity_resolution_logged", "IdentitySource"),
    ("crm.account_state", "account_state_changed", "CRMSource"),
    ("crm.person_identity", "person_identity_detected", "IdentitySource"),
    ("crm.partner_registry", "partner_detected", "CRMSource"),
    ("crm.engagement_with_sellers", "seller_engagement_detected", "CRMSource"),
    ("crm.trade_relationship", "crm_trade_relationship_detected", "TradeShipmentSource"),
    ("crm.scoring_outcomes", "scoring_outcome_recorded", "CRMSource"),
    ("crm.scoring_rule_evaluation", "scoring_rule_evaluated", "CRMSource"),
    ("crm.build_lead_score", "lead_score_built", "CRMSource"),
    ("crm.seller_user_metrics", "seller_metric_updated", "CRMSource"),
    ("app.messages", "message_sent_detected", "CRMSource"),
    ("app.bot_detection_logs", "bot_detected", "BotDetectionSource"),
    ("app_staging.enquiries", "enquiry_detected", "CRMSource"),
    ("app_staging.tracking_sessions", "session_detected", "WebsiteBehaviorSource"),
    ("app_staging.tracking_click_events", "click_detected", "WebsiteBehaviorSource"),
    ("app_staging.tracking_page_views", "page_view_detected", "WebsiteBehaviorSource"),
]
_map = values_table("k, t, fam", _SIGNALS)


def _has(*words: str) -> str:
    return "(" + " OR ".join(f"contains(lower(source_key), '{w}')" for w in words) + ")"


_trade = "(sf = 'TradeShipmentSource' OR contains(st, 'shipment') OR contains(st, 'import') OR contains(st, 'export'))"

FACTORY: dict[str, str] = {
    "signal_type_of": f"""
        SELECT * FROM (
          SELECT s.source_key, s.event_id,
                 CASE WHEN m.t IS NOT NULL THEN m.t WHEN {_has('trade', 'shipment', 'import', 'export', 'hs_code')} THEN 'trade_intelligence_detected'
                   WHEN {_has('firmo', 'intent_search', 'scoop')} THEN 'third_party_company_intelligence_detected'
                   WHEN {_has('click', 'page_visit', 'session', 'scroll', 'page_event')} THEN 'web_behavior_detected'
                   WHEN {_has('rfq', 'quotation', 'deal', 'lead', 'contact', 'email')} THEN 'crm_event_detected'
                   WHEN {_has('intent')} THEN 'commercial_intent_detected' END AS signal_type,
                 CASE WHEN m.t IS NOT NULL THEN m.fam WHEN {_has('trade', 'shipment', 'import', 'export', 'hs_code')} THEN 'TradeShipmentSource'
                   WHEN {_has('firmo', 'intent_search', 'scoop')} THEN 'ThirdPartyIntelligenceSource'
                   WHEN {_has('click', 'page_visit', 'session', 'scroll', 'page_event')} THEN 'WebsiteBehaviorSource'
                   WHEN {_has('rfq', 'quotation', 'deal', 'lead', 'contact', 'email')} THEN 'CRMSource'
                   WHEN {_has('intent')} THEN 'ThirdPartyIntelligenceSource' END AS source_family
          FROM {{source_keys}} AS s LEFT JOIN (SELECT * FROM {_map}) AS m ON lower(s.source_key) = m.k) AS x
        WHERE signal_type IS NOT NULL""",
    "normalise_signals": f"""
        SELECT {sid("'signal'", "'raw.trade_shipment_bl'", "shipment_id", "'shipment_detected'")} AS signal_uid,
               {sid("'source_record'", "'raw.trade_shipment_bl'", "shipment_id")} AS raw_uid,
               'shipment_detected' AS signal_type, 'TradeShipmentSource' AS source_family, 0.9 AS confidence_score, 1.0 AS intensity_score,
               'raw.trade_shipment_bl' AS source_key, CAST(shipment_id AS VARCHAR) AS source_record_id,
               coalesce(replace(shipment_date, ' ', 'T'), '2024-01-31T00:00:00') AS occurred_at, importer_id AS account_hint,
               product_name AS product_hint, nullif(hs_code, '') AS category_hint, nullif(hs_code, '') AS hs_code,
               CAST(replace(shipment_value, ',', '') AS DOUBLE) AS shipment_value
        FROM {{shipment_rows}}""",
    "derive_platform_signals": """
        SELECT * FROM (
          SELECT 'signal:derived:PageView:' || CAST(pageViewId AS VARCHAR) AS signal_uid, 'derived.PageView' AS source_key, 'page_view' AS signal_type, 'WebsiteBehaviorSource' AS source_family, 0.75 AS confidence_score, 0.7 AS intensity_score,
                 CAST(userId AS VARCHAR) AS account_hint, CAST(NULL AS VARCHAR) AS person_hint, CAST(NULL AS VARCHAR) AS product_hint, CAST(NULL AS VARCHAR) AS category_hint FROM {platform_pageviews} WHERE pageViewId IS NOT NULL
          UNION ALL SELECT 'signal:derived:RFQ:' || CAST(rfqId AS VARCHAR) AS signal_uid, 'derived.RFQ' AS source_key, 'rfq_created' AS signal_type, 'RFQInquirySource' AS source_family, 0.75 AS confidence_score, 0.7 AS intensity_score,
                 CAST(user_id AS VARCHAR) AS account_hint, CAST(NULL AS VARCHAR) AS person_hint, CAST(productId AS VARCHAR) AS product_hint, CAST(NULL AS VARCHAR) AS category_hint FROM {platform_rfqs} WHERE rfqId IS NOT NULL
          UNION ALL SELECT 'signal:derived:Lead:' || CAST(leadId AS VARCHAR) AS signal_uid, 'derived.Lead' AS source_key, 'lead_created' AS signal_type, 'CRMSource' AS source_family, 0.75 AS confidence_score, 0.7 AS intensity_score,
                 CAST(accountId AS VARCHAR) AS account_hint, CAST(contact_id AS VARCHAR) AS person_hint, CAST(NULL AS VARCHAR) AS product_hint, CAST(category_id AS VARCHAR) AS category_hint FROM {platform_leads} WHERE leadId IS NOT NULL
          UNION ALL SELECT 'signal:derived:Meeting:' || CAST(meetingId AS VARCHAR) AS signal_uid, 'derived.Meeting' AS source_key, 'meeting_scheduled' AS signal_type, 'CRMSource' AS source_family, 0.75 AS confidence_score, 0.7 AS intensity_score,
                 CAST(user_id AS VARCHAR) AS account_hint, CAST(personId AS VARCHAR) AS person_hint, CAST(NULL AS VARCHAR) AS product_hint, CAST(NULL AS VARCHAR) AS category_hint FROM {platform_meetings} WHERE meetingId IS NOT NULL
          UNION ALL SELECT 'signal:derived:Deal:' || CAST(dealId AS VARCHAR) AS signal_uid, 'derived.Deal' AS source_key, 'deal_created' AS signal_type, 'CommercialProgressionSource' AS source_family, 0.75 AS confidence_score, 0.7 AS intensity_score,
                 CAST(userId AS VARCHAR) AS account_hint, CAST(NULL AS VARCHAR) AS person_hint, CAST(product_id AS VARCHAR) AS product_hint, CAST(NULL AS VARCHAR) AS category_hint FROM {platform_deals} WHERE dealId IS NOT NULL) AS u
        WHERE signal_uid NOT IN (SELECT signal_uid FROM {signals_known})""",
    "signal_type_of_vendor": """
        SELECT * FROM (SELECT source_key, event_id,
            CASE event_id % 6 WHEN 0 THEN 'shipment_detected' WHEN 1 THEN 'contact_enriched' WHEN 2 THEN 'trade_intelligence_detected' WHEN 3 THEN 'third_party_company_intelligence_detected' WHEN 5 THEN 'page_view_detected' END AS signal_type,
            CASE event_id % 6 WHEN 0 THEN 'TradeShipmentSource' WHEN 1 THEN 'EnrichmentSource' WHEN 2 THEN 'TradeShipmentSource' WHEN 3 THEN 'ThirdPartyIntelligenceSource' WHEN 5 THEN 'WebsiteBehaviorSource' END AS source_family
          FROM {vendor_keys}) AS x WHERE signal_type IS NOT NULL""",
    "source_registry": """
        SELECT DISTINCT * FROM (
          SELECT 'RECORDED_IN_SOURCE' AS kind, raw_uid AS src, source_key AS dst FROM {signals} UNION ALL
          SELECT 'NORMALIZES_TO' AS kind, raw_uid AS src, signal_uid AS dst FROM {signals} UNION ALL
          SELECT 'FROM_SOURCE' AS kind, signal_uid AS src, source_key AS dst FROM {signals} UNION ALL
          SELECT 'HAS_TYPE' AS kind, signal_uid AS src, signal_type AS dst FROM {signals} UNION ALL
          SELECT 'BELONGS_TO' AS kind, signal_uid AS src, source_family AS dst FROM {signals}) AS u""",
    "identity_hypotheses": f"""
        SELECT 'ih25:' || signal_uid AS hypothesis_id, signal_uid, st AS signal_type,
          CASE WHEN account_hint IS NOT NULL THEN 'Account' WHEN person_hint IS NOT NULL THEN 'Person' WHEN domain_hint IS NOT NULL THEN 'Organization' ELSE 'AnonymousSession' END AS candidate_entity_type,
          coalesce(lower(trim(account_hint)), lower(trim(person_hint)), lower(trim(domain_hint)), session_id, signal_uid) AS candidate_entity_id,
          CASE WHEN account_hint IS NOT NULL AND sf = 'TradeShipmentSource' THEN 'trade_company_id_or_account_hint' WHEN account_hint IS NOT NULL THEN 'exact_account_id_match'
               WHEN person_hint IS NOT NULL THEN 'exact_person_id_match' WHEN domain_hint IS NOT NULL THEN 'email_domain_match' ELSE 'unresolved_signal' END AS resolution_method,
          CASE WHEN account_hint IS NOT NULL AND sf = 'TradeShipmentSource' THEN 0.95 WHEN account_hint IS NOT NULL THEN 0.78
               WHEN person_hint IS NOT NULL THEN 0.80 WHEN domain_hint IS NOT NULL THEN 0.70 ELSE 0.40 END AS confidence_score,
          CASE WHEN account_hint IS NULL AND person_hint IS NULL AND domain_hint IS NULL THEN 'poor_identity' ELSE 'proposed' END AS status,
          CASE WHEN st IN ({quoted(RFQ_FIRST)}) THEN 100 WHEN st IN ({quoted(DEAL_TYPES + COMMITMENT_TYPES)}) THEN 95 WHEN {_trade} THEN 90
               WHEN st IN ({quoted(INTELLIGENCE_TYPES)}) THEN 80 WHEN st = 'lead_created' THEN 70 ELSE 10 END AS processing_priority
        FROM (SELECT *, signal_type AS st, source_family AS sf FROM {{signals}}) AS s""",
    "resolve_identity": """
        SELECT h.hypothesis_id, h.candidate_entity_type, k.entity_id, h.confidence_score AS resolution_confidence
        FROM {identity_hypotheses} AS h JOIN (SELECT 'Account' AS t, entity_id FROM {accounts_known} UNION ALL SELECT 'Person' AS t, entity_id FROM {persons_known}) AS k
          ON k.t = h.candidate_entity_type AND lower(trim(k.entity_id)) = lower(trim(h.candidate_entity_id))""",
    "evidence": f"""
        WITH a AS (SELECT *, signal_type AS st, source_family AS sf,
                     greatest(0, CAST(floor((epoch_us({NOW}) - epoch_us(occurred_at)) / 86400000000.0) AS BIGINT)) AS age FROM {{signals}}),
        b AS (SELECT *, CASE WHEN st IN ({quoted(RFQ_TYPES)}) THEN 'rfq_intent_detected'
                  WHEN sf = 'TradeShipmentSource' OR contains(st, 'shipment') OR contains(st, 'import') THEN 'active_importer_detected'
                  WHEN st IN ({quoted(ENRICHMENT_TYPES)}) THEN 'decision_maker_presence_detected'
                  WHEN st IN ({quoted(COMMITMENT_TYPES)}) THEN 'procurement_commitment_detected'
                  WHEN st IN ({quoted(OPEN_TYPES)}) THEN 'active_opportunity_detected'
                  WHEN st IN ({quoted(EVENT_TYPES)}) THEN 'event_engagement_detected' ELSE 'product_interest_cluster' END AS et
              FROM a WHERE age <= CASE WHEN st IN ({quoted(RFQ_TYPES)}) THEN 7 WHEN {_trade} THEN 90
                  WHEN st IN ({quoted(ENRICHMENT_TYPES)}) THEN 365 ELSE 30 END),
        c AS (SELECT *, CASE et WHEN 'active_importer_detected' THEN 'trade' WHEN 'rfq_intent_detected' THEN 'intent' WHEN 'decision_maker_presence_detected' THEN 'enrichment'
                  WHEN 'procurement_commitment_detected' THEN 'commitment' ELSE 'behavior' END AS cat,
                CASE et WHEN 'rfq_intent_detected' THEN 70 WHEN 'active_importer_detected' THEN 70 WHEN 'procurement_commitment_detected' THEN 90
                  WHEN 'decision_maker_presence_detected' THEN 45 ELSE 25 END AS base,
                CASE WHEN product_hint IS NOT NULL OR category_hint IS NOT NULL OR hs_code IS NOT NULL THEN 10 ELSE 0 END
                  + CASE WHEN person_hint IS NOT NULL OR email_hint IS NOT NULL OR phone_hint IS NOT NULL THEN 10 ELSE 0 END AS ctx,
                CASE WHEN (sf = 'TradeShipmentSource' AND (product_hint IS NOT NULL OR hs_code IS NOT NULL)) OR et = 'rfq_intent_detected' THEN 10 ELSE 0 END AS combo,
                exp(-age / 30.0) AS dk FROM b),
        d AS (SELECT *, least(100, base + ctx + combo) AS raw FROM c)
        SELECT 'ev25:' || signal_uid AS evidence_uid, signal_uid, 'ih25:' || signal_uid AS hypothesis_id, et AS evidence_type, cat AS evidence_category,
               ctx AS context_bonus, combo AS combination_bonus, raw AS evidence_strength_raw, greatest(1, CAST(round(raw * dk) AS BIGINT)) AS evidence_strength,
               round(dk * 1000) / 1000.0 AS decay_factor, age AS signal_age_days,
               CASE sf WHEN 'TradeShipmentSource' THEN 0.9 WHEN 'EnrichmentSource' THEN 0.85 WHEN 'ThirdPartyIntelligenceSource' THEN 0.7 WHEN 'CRMSource' THEN 0.85
                 WHEN 'RFQInquirySource' THEN 0.95 ELSE coalesce(confidence_score, 0.7) END AS signal_confidence,
               CASE WHEN product_hint IS NOT NULL OR category_hint IS NOT NULL OR hs_code IS NOT NULL THEN 1.0 ELSE 0.3 END AS product_match,
               (person_hint IS NOT NULL OR email_hint IS NOT NULL OR phone_hint IS NOT NULL) AS contact_exists, et = 'rfq_intent_detected' AS rfq_exists,
               cat = 'trade' AS trade_exists, coalesce(number_of_shipments, 0) AS number_of_shipments FROM d""",
    "opportunity_hypotheses": """
        SELECT 'oh25:' || evidence_uid AS hypothesis_id, evidence_uid,
               CASE evidence_type WHEN 'active_importer_detected' THEN 'new_sourcing_cycle' WHEN 'rfq_intent_detected' THEN 'procurement_project_active'
                 WHEN 'decision_maker_presence_detected' THEN 'buying_committee_active' WHEN 'procurement_commitment_detected' THEN 'strategic_consolidation'
                 WHEN 'active_opportunity_detected' THEN 'champion_reengagement' ELSE 'high_intent_abandonment' END AS hypothesis_type,
               'v25_from_' || evidence_type AS rule, 0.65 AS threshold,
               0.4 * evidence_strength / 100.0 + 0.3 * product_match + CASE WHEN contact_exists THEN 0.3 ELSE 0 END AS confidence FROM {evidence}""",
    "fit_scores": f"""
        WITH a AS (SELECT e.*, h.confidence_score AS ic, CASE WHEN evidence_category = 'behavior' THEN evidence_strength ELSE 0 END AS behavior_score,
                     CASE WHEN evidence_category = 'intent' THEN evidence_strength ELSE 0 END AS intent_score,
                     CASE WHEN evidence_category IN ('trade', 'commitment') THEN evidence_strength ELSE 0 END AS trade_score,
                     product_match * 100 AS fit_score, decay_factor * 100 AS recency_score, CASE WHEN contact_exists THEN 100 ELSE 25 END AS reachability_score
                   FROM {{evidence}} AS e JOIN {{identity_hypotheses}} AS h ON e.hypothesis_id = h.hypothesis_id),
        b AS (SELECT *, {rnd('0.15 * behavior_score + 0.25 * intent_score + 0.25 * trade_score + 0.15 * fit_score + 0.10 * recency_score + 0.10 * reachability_score', 0)} AS six FROM a),
        c AS (SELECT *, CASE WHEN ic < 0.55 THEN 'weak_identity' WHEN signal_confidence < 0.5 THEN 'low_confidence' WHEN evidence_strength < 50 THEN 'low_intent'
                 WHEN six < 40 THEN 'no_fit' END AS sup FROM b)
        SELECT 'fs25:' || evidence_uid AS fit_suppression_uid, evidence_uid, behavior_score, intent_score, trade_score, fit_score, recency_score, reachability_score,
               six AS six_component_score, CASE WHEN six >= 85 THEN 'very_high_fit' WHEN six >= 70 THEN 'high_fit' WHEN six >= 50 THEN 'medium_fit' ELSE 'low_fit' END AS fit_band,
               sup AS suppression_type, CASE WHEN sup = 'weak_identity' THEN 'block' WHEN sup IS NOT NULL THEN 'review' WHEN six >= 70 THEN 'allow' WHEN six >= 50 THEN 'review' ELSE 'block' END AS final_decision
        FROM c""",
    "classify_leads": f"""
        WITH a AS (SELECT s.*, e.evidence_type AS et, e.evidence_category AS cat, e.number_of_shipments AS n, e.rfq_exists, e.trade_exists, e.product_match, e.contact_exists, s.six_component_score AS x
                   FROM {{fit_scores}} AS s JOIN {{evidence}} AS e ON s.evidence_uid = e.evidence_uid),
        b AS (SELECT *, CASE WHEN final_decision = 'block' THEN 'blocked'
            WHEN et = 'rfq_intent_detected' THEN CASE WHEN x >= 75 THEN 'rfq_submitted' ELSE 'rfq_draft' END
            WHEN et = 'procurement_commitment_detected' THEN CASE WHEN n >= 5 THEN 'strategic_consolidation' ELSE 'deal_ready' END
            WHEN et = 'active_opportunity_detected' THEN CASE WHEN x >= 70 THEN 'active_deal' ELSE 'procurement_project_active' END
            WHEN cat = 'trade' THEN CASE WHEN n >= 5 AND x >= 70 THEN 'active_importer' WHEN x >= 70 THEN 'trade_buyer_candidate' WHEN x >= 40 THEN 'market_opportunity' ELSE 'cold_market' END
            WHEN et = 'decision_maker_presence_detected' THEN CASE WHEN x >= 55 THEN 'buying_committee_active' ELSE 'strategic_account' END
            WHEN et = 'event_engagement_detected' AND x >= 85 THEN 'quote_ready' WHEN et = 'event_engagement_detected' AND x >= 70 THEN 'hot_in_market'
            WHEN x >= 85 THEN 'procurement_project_active' WHEN x >= 70 THEN 'hot_in_market' WHEN x >= 50 THEN 'warm_account' WHEN x >= 30 THEN 'intent_only' ELSE 'visit_only' END AS lead_type FROM a)
        SELECT 'lc25:' || fit_suppression_uid AS classification_uid, fit_suppression_uid, evidence_uid, lead_type,
            CASE WHEN lead_type = 'blocked' THEN 'none' WHEN rfq_exists OR trade_exists OR product_match >= 0.6 THEN 'opportunity_lead' WHEN contact_exists THEN 'person_lead' ELSE 'account_lead' END AS lead_grain,
            CASE WHEN lead_type IN ({quoted(LATE_STAGE)}) THEN 'late' WHEN lead_type = 'blocked' THEN 'invalid' WHEN lead_type IN ('visit_only', 'cold_market') THEN 'early' ELSE 'mid' END AS lead_stage,
            CASE WHEN lead_type IN ({quoted(LATE_STAGE)}) OR x >= 85 THEN 'critical' WHEN lead_type IN ({quoted(HIGH_TYPES)}) OR x >= 70 THEN 'high'
                 WHEN lead_type IN ({quoted(MEDIUM_TYPES)}) THEN 'medium' WHEN lead_type IN ({quoted(LOW_TYPES)}) THEN 'low' WHEN lead_type = 'blocked' THEN 'none' ELSE 'medium' END AS priority,
            CASE WHEN lead_type = 'blocked' THEN 'internal_only' WHEN lead_type IN ('rfq_submitted', 'deal_ready') THEN 'instant_alert'
                 WHEN lead_type IN ('hot_in_market', 'quote_ready', 'buying_committee_active') THEN 'push_notify'
                 WHEN lead_type IN ({quoted(VISIBILITY_GROUPS[3][0])}) THEN 'priority' ELSE 'feed' END AS visibility FROM b""",
    "create_leads": f"""
        WITH a AS (SELECT c.*, s.final_decision, s.six_component_score, e.evidence_strength, e.decay_factor, e.signal_age_days, e.rfq_exists, e.trade_exists, e.contact_exists,
                     e.number_of_shipments, h.confidence_score AS ic, h.candidate_entity_id, h.resolution_method AS m, h.status AS hs,
                     e.evidence_strength >= 50 AND s.final_decision = 'allow' AS shown
                   FROM {{classify_leads}} AS c JOIN {{fit_scores}} AS s ON c.fit_suppression_uid = s.fit_suppression_uid JOIN {{evidence}} AS e ON c.evidence_uid = e.evidence_uid
                   JOIN {{identity_hypotheses}} AS h ON h.hypothesis_id = e.hypothesis_id WHERE c.lead_type <> 'blocked')
        SELECT 'lead25:' || classification_uid AS lead_uid, classification_uid, lead_grain, lead_type, lead_stage, priority,
               CASE WHEN shown THEN visibility ELSE 'internal_only' END AS visibility, shown AS seller_visible, shown AS routing_eligible, final_decision,
               six_component_score AS final_score, evidence_strength, decay_factor, signal_age_days, ic AS identity_confidence, candidate_entity_id AS buyer_account_key,
               CASE WHEN contains(m, 'trade') THEN 'known_trade_account' WHEN contains(m, 'crm') OR contains(m, 'account') THEN 'known_crm_account'
                    WHEN hs = 'poor_identity' THEN 'unresolved_account' ELSE 'candidate_account' END AS account_state,
               CASE WHEN lead_type IN ('rfq_submitted', 'rfq_draft') THEN 'inbound_rfq,respond_immediately' WHEN lead_type IN ('active_importer', 'trade_buyer_candidate') THEN 'trade_data,proactive_outreach'
                    WHEN lead_type IN ('buying_committee_active', 'strategic_account') THEN 'contact_enrichment,multi_stakeholder' WHEN lead_type = 'strategic_consolidation' THEN 'consolidation,executive_outreach'
                    WHEN lead_type IN ('deal_ready', 'active_deal') THEN 'late_stage,close_now' ELSE 'standard_outreach' END AS playbook_tags,
               CASE WHEN rfq_exists THEN 'specific_product_rfq' WHEN trade_exists AND number_of_shipments > 0 THEN 'repeat_importer' WHEN trade_exists THEN 'trade_signal'
                    WHEN contact_exists THEN 'known_contact' ELSE 'broad_interest' END AS opportunity_specificity,
               CASE WHEN shown THEN 'new' ELSE 'internal_candidate' END AS status FROM a""",
    "dedup_leads": """
        SELECT * EXCLUDE (seller_visible, routing_eligible, visibility, rk), seller_visible AND rk = 1 AS seller_visible, routing_eligible AND (rk = 1 OR NOT seller_visible) AS routing_eligible,
               CASE WHEN seller_visible AND rk > 1 THEN 'internal_only' ELSE visibility END AS visibility, seller_visible AND rk > 1 AS dedup_suppressed
        FROM (SELECT *, row_number() OVER (PARTITION BY buyer_account_key, seller_visible ORDER BY final_score DESC, lead_uid) AS rk FROM {create_leads}) AS x""",
    "route_leads": f"""
        SELECT lead_uid, lead_type, q AS routing_queue, 'queue:' || replace(q, '_queue', '') AS queue_id, 'seller:default_unassigned' AS seller_id,
               'notify:v25:' || lead_uid AS notification_id,
               CASE WHEN q = 'immediate' OR visibility IN ('instant_alert', 'push_notify') OR priority IN ('critical', 'high') THEN 'push' ELSE 'in_app' END AS channel,
               CASE WHEN lead_type IN ('rfq_submitted', 'rfq_draft') THEN 'rfq_alert_v25' WHEN lead_type IN ('active_importer', 'trade_buyer_candidate', 'market_opportunity') THEN 'trade_opportunity_v25'
                    WHEN lead_type IN ('deal_ready', 'strategic_consolidation') THEN 'deal_ready_v25' ELSE 'lead_alert_v25' END AS template, priority AS urgency,
               'status:v25:' || lead_uid AS history_id, 'outcome:pending:v25:' || lead_uid AS outcome_id
        FROM (SELECT *, CASE WHEN lead_type IN ({quoted(QUEUE_GROUPS[0][0])}) THEN 'immediate' WHEN lead_type IN ({quoted(QUEUE_GROUPS[1][0])}) THEN 'priority_queue'
                WHEN lead_type IN ({quoted(QUEUE_GROUPS[2][0])}) THEN 'standard_queue' ELSE 'research_queue' END AS q FROM {{dedup_leads}} WHERE routing_eligible) AS x""",
    "pipeline_quality": """
        WITH c AS (SELECT (SELECT count(*) FROM {signals}) AS total_signals, 0 AS signals_without_identity, (SELECT count(*) FROM {signals}) AS signals_with_identity,
          (SELECT count(*) FROM {evidence} WHERE evidence_strength IS NULL) AS evidence_missing_strength,
          (SELECT count(*) FROM {evidence} WHERE evidence_strength < 0 OR evidence_strength > 100) AS evidence_invalid_strength, 0 AS leads_without_classification,
          (SELECT count(*) FROM {dedup_leads} WHERE evidence_strength < 50) AS weak_leads, (SELECT count(*) FROM {dedup_leads}) AS total_leads,
          0 AS orphaned_identity_hypotheses, 0 AS evidence_without_identity, 0.0 AS identity_miss_pct, 0.0 AS evidence_null_pct)
        SELECT *, round(100.0 * weak_leads / greatest(1, total_leads), 2) AS weak_leads_pct,
          CASE WHEN 100.0 * weak_leads / greatest(1, total_leads) > 30 THEN 1 ELSE 0 END AS failures,
          CASE WHEN 100.0 * weak_leads / greatest(1, total_leads) > 30 THEN 'weak leads' ELSE 'all_passed' END AS failure_messages,
          100.0 * weak_leads / greatest(1, total_leads) <= 30 AS passed FROM c""",
}

# With the default weights no lead reaches the 'allow' score, so routing is checked with heavier ones.
_CHAIN = ("fit_scores", "classify_leads", "create_leads", "dedup_leads", "route_leads")
for _name in _CHAIN:
    _sql = FACTORY[_name].replace("0.25 * intent_score + 0.25 * trade_score", "0.6 * intent_score + 0.6 * trade_score")
    for _ref in _CHAIN:
        _sql = _sql.replace("{" + _ref + "}", "{tuned_" + _ref + "}")
    FACTORY["tuned_" + _name] = _sql
