"""DuckDB statements for views and streams (streams must equal the batch answer over the same events)."""

from leadloom.checks.oracle_trade import TRADE
from leadloom.checks.sqltext import rnd, values_table, words

# Fixed values, written here again so that a wrong one in an operator shows: weights of clicks, health states, buying titles.
CLICK_ELEMENTS = [
    ("Get Quote Now", 3), ("Get Quote", 3), ("Send a Query", 2), ("Contact Supplier", 2), ("Chat with Seller", 2),
    ("Technical Specifications", 1), ("Packaging Details", 1), ("Certifications and Compliance", 1), ("Company Profile", 1)]
CLICK_BUTTONS = [
    ("getQuoteButton", 3), ("getquotebutton", 3), ("contact-seller", 2), ("contact_seller", 2), ("send-query", 2),
    ("Chat with Seller", 2), ("add-to-contact", 2), ("catalog-download", 2), ("company-profile", 1),
    ("Technical Specifications-product-specifciation-Tab", 1), ("Packaging Details-product-specifciation-Tab", 1),
    ("Certifications and Compliance-product-specifciation-Tab", 1), ("Shipping option-product-specifciation-Tab", 1),
    ("Warranty Information-product-specifciation-Tab", 1), ("Product Description-product-specifciation-Tab", 1),
    ("Return Policy-product-specifciation-Tab", 1), ("product-image-click", 1), ("visit-store-link", 1), ("view-more-pdp", 1)]
_STATUSES = ("churned", "dormant", "stressed", "irregular", "healthy")
_TITLES = [
    "procurement", "purchasing", "supply chain", "sourcing", "supplier", "category manager", "buyer", "head of supply",
    "vp supply", "director of supply", "chief supply", "chief procurement", "cpo", "director of procurement",
    "vp procurement", "global procurement", "strategic sourcing", "materials manager", "vendor management", "supply manager"]
# HS chapters by number.
_CHAPTERS = [
    ("01", "Live animals"), ("02", "Meat & edible offal"), ("03", "Fish & seafood"), ("04", "Dairy & eggs"), ("05", "Animal products"),
    ("06", "Live plants & flowers"), ("07", "Edible vegetables"), ("08", "Edible fruits & nuts"), ("09", "Coffee, tea & spices"), ("10", "Cereals"),
    ("11", "Milling products"), ("12", "Oil seeds"), ("13", "Lac & gums"), ("14", "Vegetable plaiting materials"),
    ("15", "Animal/vegetable fats & oils"), ("16", "Preparations of meat/fish"), ("17", "Sugars & confectionery"), ("18", "Cocoa & preparations"),
    ("19", "Cereal/flour/starch preparations"), ("20", "Preparations of vegetables/fruits"), ("21", "Miscellaneous food preparations"),
    ("22", "Beverages, spirits & vinegar"), ("23", "Residues & food industry waste"), ("24", "Tobacco"), ("25", "Salt, sulphur, earths & stone"),
    ("26", "Ores & slag"), ("27", "Mineral fuels & oils"), ("28", "Inorganic chemicals"), ("29", "Organic chemicals"),
    ("30", "Pharmaceutical products"), ("31", "Fertilisers"), ("32", "Tanning & dyeing extracts"), ("33", "Essential oils & cosmetics"),
    ("34", "Soap & waxes"), ("35", "Albuminoidal substances & enzymes"), ("36", "Explosives & pyrotechnics"), ("37", "Photographic goods"),
    ("38", "Miscellaneous chemical products"), ("39", "Plastics"), ("40", "Rubber"), ("41", "Raw hides & skins"), ("42", "Leather articles"),
    ("43", "Furskins"), ("44", "Wood & wood products"), ("45", "Cork"), ("46", "Straw & basketware"), ("47", "Pulp of wood"),
    ("48", "Paper & paperboard"), ("49", "Printed books & newspapers"), ("50", "Silk"), ("51", "Wool"), ("52", "Cotton"),
    ("53", "Other vegetable textile fibres"), ("54", "Man-made filaments"), ("55", "Man-made staple fibres"), ("56", "Wadding & felt"),
    ("57", "Carpets"), ("58", "Special woven fabrics"), ("59", "Impregnated textile fabrics"), ("60", "Knitted fabrics"), ("61", "Knitted apparel"),
    ("62", "Woven apparel"), ("63", "Other textile articles"), ("64", "Footwear"), ("65", "Headgear"), ("66", "Umbrellas"),
    ("67", "Feathers & artificial flowers"), ("68", "Stone & cement articles"), ("69", "Ceramic products"), ("70", "Glass"),
    ("71", "Precious stones & metals"), ("72", "Iron & steel"), ("73", "Iron/steel articles"), ("74", "Copper"), ("75", "Nickel"),
    ("76", "Aluminium"), ("78", "Lead"), ("79", "Zinc"), ("80", "Tin"), ("81", "Other base metals"), ("82", "Tools & cutlery"),
    ("83", "Miscellaneous metal articles"), ("84", "Machinery & mechanical appliances"), ("85", "Electrical machinery & equipment"),
    ("86", "Railway equipment"), ("87", "Vehicles"), ("88", "Aircraft"), ("89", "Ships & boats"), ("90", "Optical & medical instruments"),
    ("91", "Clocks & watches"), ("92", "Musical instruments"), ("93", "Arms & ammunition"), ("94", "Furniture & bedding"), ("95", "Toys & games"),
    ("96", "Miscellaneous manufactures"), ("97", "Works of art")]
_chapters = values_table("ch, name", _CHAPTERS)
_elements = values_table("name, w", CLICK_ELEMENTS)
_buttons = values_table("name, w", CLICK_BUTTONS)
_stat = ", ".join(f"count(*) FILTER (WHERE health_status = '{s}') AS {s}" for s in _STATUSES)
_stat3 = ", ".join(f"count(*) FILTER (WHERE health_status = '{s}') AS {s}" for s in _STATUSES[:3])

VIEWS: dict[str, str] = {
    "valued": """
        SELECT r.rel_id, r.buyer_name, r.supplier_name, r.hs_code, r.total_shipments, r.baseline_avg_value AS buyer_monthly_volume, h.health_score, h.health_status
        FROM {trade_relationships} AS r LEFT JOIN {health_status} AS h ON h.rel_id = r.rel_id""",
    "trade_view": """
        SELECT w.*, (SELECT count(*) FROM {switch_opportunities} AS o WHERE o.rel_id = w.rel_id) AS opportunity_count FROM (SELECT * FROM {valued} WHERE buyer_monthly_volume >= 1000 AND health_status = 'stressed'
        ) AS w""",
    "trade_stats": f"""
        SELECT count(*) AS total_relationships, {rnd('sum(buyer_monthly_volume)', 2)} AS total_monthly_volume, {rnd('avg(buyer_monthly_volume)', 2)} AS avg_monthly_volume,
               {rnd('max(buyer_monthly_volume)', 2)} AS max_monthly_volume, {rnd('avg(health_score)', 1)} AS avg_health_score, {_stat} FROM {{valued}}""",
    "profile_view": "SELECT user_id, behavioral_score, enquiries_sent, 'high' AS intent_band FROM {behavior_score} WHERE behavioral_score >= 70 AND enquiries_sent > 0",
    "profile_stats": f"""
        SELECT count(*) AS total_profiles, {rnd('avg(behavioral_score)', 1)} AS avg_behavioral_score, count(*) FILTER (WHERE behavioral_score >= 70) AS high_intent, count(*) FILTER (WHERE behavioral_score >= 50 AND behavioral_score < 70) AS medium_intent,
               count(*) FILTER (WHERE behavioral_score < 50) AS low_intent, count(*) FILTER (WHERE enquiries_sent > 0) AS with_enquiries, count(*) FILTER (WHERE max_scroll_depth >= 75) AS deep_readers,
               sum(total_clicks) AS platform_clicks, sum(enquiries_sent) AS total_enquiries FROM {{behavior_score}}""",
    "opportunity_view": """
        SELECT o.opportunity_id, o.rel_id, o.detection_method, h.health_score, h.health_status, o.switch_probability FROM {score_opportunities} AS o LEFT JOIN {health_status} AS h ON h.rel_id = o.rel_id""",
    "detection_comparison": f"""
        SELECT o.detection_method, count(*) AS total, {rnd('avg(h.health_score)', 1)} AS avg_health_score, {rnd('avg(o.switch_probability * 100)', 1)} AS avg_switch_prob_pct, {_stat3}
        FROM {{score_opportunities}} AS o LEFT JOIN {{health_status}} AS h ON h.rel_id = o.rel_id GROUP BY o.detection_method""",
    "pipeline_counts": """
        SELECT 'Lead' AS label, count(*) AS rows FROM {leads}
        UNION ALL SELECT 'BuyerProfile' AS label, count(*) AS rows FROM {behavior_score}
        UNION ALL SELECT 'TradeRelationship' AS label, count(*) AS rows FROM {trade_relationships}
        UNION ALL SELECT 'SwitchLead' AS label, count(*) AS rows FROM {switch_leads_matched}
        UNION ALL SELECT 'SupplierSwitchOpportunity' AS label, count(*) AS rows FROM {switch_opportunities}
        UNION ALL SELECT 'Seller' AS label, count(*) AS rows FROM {sellers}
        UNION ALL SELECT 'SellerLeadAssignment' AS label, count(*) AS rows FROM {assignments}
        UNION ALL SELECT 'ConversionFact' AS label, count(*) AS rows FROM {conversion_facts}""",
    "pipeline_status": """
        SELECT 'table' AS part, label, rows, CAST(NULL AS TIMESTAMP) AS latest_at FROM {pipeline_counts} UNION ALL SELECT 'latest_lead', 'Lead', NULL, CAST(max(classified_at) AS TIMESTAMP) FROM {leads}
        UNION ALL SELECT 'lead_type', lead_type, count(*), NULL FROM {leads} GROUP BY lead_type UNION ALL SELECT 'detection_method', detection_method, count(*), NULL FROM {switch_opportunities} GROUP BY detection_method""",
    "enriched_leads": f"""
        SELECT s.lead_id, s.buyer_name, o.existing_supplier_name, s.candidate_supplier_name, s.hs_code, coalesce(c.name, 'HS ' || s.hs_code) AS hs_description, s.final_lead_score,
               CASE WHEN coalesce(h.health_score, o.stress_score) < 40 OR s.switch_probability * 100 >= 60 THEN 'HIGH' WHEN coalesce(h.health_score, o.stress_score) < 70 OR s.switch_probability * 100 >= 35 THEN 'MEDIUM' ELSE 'LOW' END AS urgency,
               coalesce(h.health_score, o.stress_score) AS health_score, r.baseline_avg_qty AS monthly_volume, r.total_shipments, CAST(floor(datediff('day', r.last_shipment_date, DATE '2001-11-05') / 30.0) AS BIGINT) AS months_since_last,
               s.switch_probability * 100 >= 60 AS act_within_two_weeks
        FROM {{switch_leads_matched}} AS s LEFT JOIN {{score_opportunities}} AS o ON o.opportunity_id = s.opportunity_id LEFT JOIN {{trade_relationships}} AS r ON r.rel_id = o.rel_id
        LEFT JOIN {{health_status}} AS h ON h.rel_id = o.rel_id LEFT JOIN (SELECT * FROM {_chapters}) AS c ON c.ch = substr(s.hs_code, 1, 2)
        QUALIFY row_number() OVER (PARTITION BY s.buyer_id ORDER BY s.final_lead_score DESC, s.lead_id DESC) = 1""",
    "named_contacts": TRADE["contacts"].replace("{contact_rows}", "{named_contact_rows}"),
    "decision_makers": f"""
        WITH x AS (SELECT DISTINCT s.company_name AS company FROM {{company_search}} AS s),
        m AS (SELECT x.company, c.person_key, c.title, c.email, {words('c.title', _TITLES)} AS is_maker FROM x JOIN {{named_contacts}} AS c ON contains(lower(c.company_name), lower(x.company))),
        n AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY CASE WHEN is_maker THEN 0 ELSE 1 END, person_key) AS rank, bool_or(is_maker) OVER (PARTITION BY company) AS any_maker FROM m)
        SELECT company, person_key, title, email, is_maker, rank FROM n WHERE rank <= 5 AND (CASE WHEN any_maker THEN is_maker ELSE rank <= 3 END)""",
    "lead_summary": "SELECT (SELECT count(*) FROM {switch_leads_matched}) AS total_switch_leads, (SELECT count(*) FROM {trade_relationships}) AS trade_relationships_monitored, (SELECT count(*) FROM {switch_opportunities}) AS stressed_relationships",
    "seller_dashboard": f"""
        WITH c AS (SELECT seller_id, count(*) AS total_assigned, count(*) FILTER (WHERE status = 'converted') AS converted, count(*) FILTER (WHERE status = 'rejected') AS rejected,
                count(*) FILTER (WHERE status = 'assigned' AND assigned_at >= TIMESTAMP '2001-07-25 00:00:00') AS new_last_7d FROM {{assignments}} GROUP BY seller_id)
        SELECT s.seller_id, s.name, s.tier, coalesce(c.total_assigned, 0) AS total_assigned, coalesce(c.converted, 0) AS converted, coalesce(c.rejected, 0) AS rejected, coalesce(c.new_last_7d, 0) AS new_last_7d,
               coalesce(a.credits_available, 0) AS credits_available, {rnd('100.0 * coalesce(c.converted, 0) / greatest(1, coalesce(c.total_assigned, 0))', 1)} AS conversion_rate_pct, a.credits_total_month = -1 AS credits_unlimited,
               CASE WHEN a.credits_total_month > 0 THEN {rnd('100.0 * a.credits_used_month / a.credits_total_month', 1)} ELSE 0 END AS credits_used_pct
        FROM {{sellers}} AS s LEFT JOIN c ON c.seller_id = s.seller_id LEFT JOIN {{accounts}} AS a ON a.seller_id = s.seller_id""",
    "seller_performance": f"""
        SELECT a.seller_id, l.lead_type, count(*) AS total, count(*) FILTER (WHERE a.status = 'converted') AS converted, count(*) FILTER (WHERE a.status = 'rejected') AS rejected, avg(l.score_final) AS avg_score,
               {rnd("100.0 * count(*) FILTER (WHERE a.status = 'converted') / count(*)", 1)} AS conv_rate_pct FROM {{assignments}} AS a JOIN {{leads}} AS l ON l.lead_uid = a.lead_id GROUP BY a.seller_id, l.lead_type""",
    "assigned_leads": f"""
        WITH u AS (SELECT lead_uid AS lead_id, lead_type, priority, CAST(score_final AS DOUBLE) AS score, coalesce(playbook_tags, '') AS tags, CAST(NULL AS VARCHAR) AS action, hs_code FROM {{lead_tags}}
            UNION ALL SELECT lead_id, 'switch_lead' AS lead_type, lead_priority AS priority, final_lead_score AS score, '' AS tags, recommended_action AS action, hs_code FROM {{switch_leads_matched}}),
        g AS (SELECT assignment_id, seller_id, lead_id, status FROM {{assignments}} UNION ALL SELECT 'sw:' || seller_id || ':' || lead_id AS assignment_id, seller_id, lead_id, 'assigned' AS status
            FROM (SELECT lead_id, 'SL1' AS seller_id FROM {{switch_leads_matched}} UNION SELECT lead_id, 'SL' || substr(lead_id, 1, 1) AS seller_id FROM {{switch_leads_matched}}) AS w),
        j AS (SELECT g.assignment_id, g.seller_id, g.status, u.*, row_number() OVER (PARTITION BY g.seller_id ORDER BY CASE u.priority WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 ELSE 4 END, u.score DESC, g.assignment_id) AS rank
              FROM g JOIN u ON u.lead_id = g.lead_id)
        SELECT assignment_id, seller_id, lead_id, lead_type, priority, score, rank, coalesce(c.name, 'Unknown') AS hs_description,
               CASE WHEN action <> '' THEN action WHEN tags <> '' THEN 'Send personalised outreach referencing trade data,Prepare consolidation proposal for executive sponsor' ELSE 'Review profile and add to nurture sequence' END AS action_steps,
               CASE WHEN priority = 'critical' OR score >= 85 THEN 'HIGH' WHEN priority = 'high' OR score >= 70 THEN 'MEDIUM' ELSE 'LOW' END AS urgency
        FROM j LEFT JOIN (SELECT * FROM {_chapters}) AS c ON c.ch = substr(j.hs_code, 1, 2) WHERE rank > 20 AND rank <= 40""",
    "sellers_list": "SELECT s.seller_id, s.name, s.tier, s.active, s.max_leads_per_day, s.leads_today, coalesce(a.credits_available, 0) AS credits_available FROM {sellers} AS s LEFT JOIN {accounts} AS a ON a.seller_id = s.seller_id",
    # --- streams ---------------------------------------------------------------------------------
    "route_events": """
        WITH x AS (SELECT *, CASE WHEN topic = 'crm.buyer_clicks' THEN ['click'] WHEN topic = 'crm.rfq_submitted' THEN ['rfq']
                WHEN topic = 'crm.lead_updates' THEN [CASE _source_table WHEN 'crm.deals' THEN 'deal' WHEN 'crm.account_risk_flags' THEN 'risk_flag' ELSE 'lead' END]
                WHEN _source_table = 'crm.page_event_trackings' AND button_identity <> '' THEN ['click'] WHEN _source_table = 'crm.page_visits' AND element_name <> '' THEN ['click', 'session'] ELSE ['session'] END AS hs FROM {web_events}),
        y AS (SELECT *, unnest(hs) AS handler FROM x)
        SELECT event_key, topic, _source_table AS source_table, handler, CASE WHEN handler = 'click' AND button_identity = '' THEN coalesce(element_name, '') ELSE button_identity END AS button_identity, user_id, element_type, _polled_at FROM y""",
    "read_events": "SELECT event_key, user_id, topic, _polled_at FROM {web_events}",
    "dedup_events": "SELECT DISTINCT event_key, user_id, topic FROM {web_events}",
    "stream_trade": "SELECT * FROM {monthly_trade}",
    "stream_stress": "SELECT * FROM {stress_rules}",
    "stream_profiles": f"""
        SELECT r.user_id, count(*) FILTER (WHERE r.handler = 'session') AS total_sessions, count(*) FILTER (WHERE r.handler = 'click') AS total_clicks,
               coalesce(sum(CASE WHEN r.handler = 'click' THEN coalesce(e.w, b.w, 0) END), 0) AS high_intent_score, max(r._polled_at) AS last_activity_at
        FROM {{route_events}} AS r LEFT JOIN (SELECT * FROM {_elements}) AS e ON e.name = r.element_type LEFT JOIN (SELECT * FROM {_buttons}) AS b ON b.name = r.button_identity
        WHERE r.handler IN ('click', 'session') AND r.user_id <> '0' GROUP BY r.user_id""",
    "last_web": "SELECT * FROM {web_events} QUALIFY row_number() OVER (PARTITION BY id ORDER BY _polled_at DESC, event_key DESC) = 1",
    "stream_rfq": """
        SELECT 'rfq:' || id AS source_ref, CASE status WHEN 'quoted' THEN 'quote_ready' WHEN 'processed' THEN 'rfq_submitted' ELSE 'rfq_draft' END AS lead_type,
               CASE status WHEN 'quoted' THEN 90 WHEN 'processed' THEN 85 ELSE 65 END AS score_final FROM {last_web}""",
    "stream_lead_update": """
        SELECT 'crm_lead:' || id AS source_ref, CASE WHEN status = 'won' THEN 'quote_ready' WHEN message <> '' THEN 'known_account_interest' WHEN status <> '' THEN 'engaged_account' ELSE 'known_person_interest' END AS lead_type,
               CASE WHEN status = 'won' THEN 90 WHEN message <> '' THEN 68 WHEN status <> '' THEN 70 ELSE 68 END AS score_final FROM {last_web}""",
    "stream_deals": "SELECT 'deal:' || id AS source_ref, 'engaged_account' AS lead_type, 70 AS score_final, 'priority' AS visibility_level FROM {last_web}",
    "stream_risk": """
        SELECT l.lead_uid, l.suppressed OR (f.r IS NOT NULL AND l.lead_type IS DISTINCT FROM 'suppressed_noise' AND l.lead_type IS NOT NULL) AS suppressed,
               CASE WHEN f.r IS NOT NULL AND l.lead_type <> 'suppressed_noise' AND NOT l.suppressed THEN f.r END AS suppression_reason
        FROM {account_leads} AS l LEFT JOIN (SELECT account_uid, min(risk_type) AS r FROM {flag_events} GROUP BY account_uid) AS f ON f.account_uid = l.account_uid WHERE l.lead_type IS NOT NULL""",
    "stream_identity": """
        SELECT l.lead_uid, i.confidence_score AS identity_confidence, i.organization_name AS org_name_resolved, m.status AS crm_status, m.score_final AS crm_score
        FROM {account_leads} AS l LEFT JOIN {identities} AS i ON i.account_uid = l.account_uid LEFT JOIN {masters} AS m ON m.lead_uid = l.lead_uid""",
    "stream_email": """
        WITH RECURSIVE e AS (SELECT lead_uid, CASE WHEN event_type IN ('Clicked', 'open') THEN 5 ELSE -10 END AS d, row_number() OVER (PARTITION BY lead_uid ORDER BY "at", event_id) AS n FROM {emails} WHERE event_type <> 'sent'),
        s AS (SELECT lead_uid, CAST(score_final AS BIGINT) AS x, 0 AS n FROM {leads} UNION ALL SELECT s.lead_uid, least(100, greatest(10, s.x + e.d)) AS x, e.n FROM s JOIN e ON e.lead_uid = s.lead_uid AND e.n = s.n + 1)
        SELECT lead_uid, arg_max(x, n) AS score_final FROM s GROUP BY lead_uid""",
    "activity_tumbling": "SELECT user_id, date_trunc('day', ts) AS start, date_trunc('day', ts) + INTERVAL 1 DAY AS \"end\", count(*) AS events, sum(value) AS value FROM {events} GROUP BY user_id, date_trunc('day', ts)",
    "activity_sliding": """
        SELECT user_id, w AS start, w + INTERVAL 1 DAY AS "end", count(*) AS events, sum(value) AS value FROM (SELECT *, unnest([b, b - INTERVAL 6 HOUR, b - INTERVAL 12 HOUR, b - INTERVAL 18 HOUR]) AS w
          FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01 00:00:00') AS b FROM {events}) AS x) AS y GROUP BY user_id, w""",
    "activity_session": """
        SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS events, sum(value) AS value FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM (
          SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE > ts THEN 0 ELSE 1 END AS fresh FROM {events}) AS x) AS y GROUP BY user_id, n""",
    "publish_events": """
        SELECT 'kg.buyer_profiles' AS topic, user_id AS key, concat('{"event_type":"buyer_profile.score_updated","event_time":"2024-01-31T00:00:00","user_id":"', user_id, '","behavioral_score":', behavioral_score, ',"total_sessions":', total_sessions,
               ',"high_intent_score":', high_intent_score, ',"searches_done":', searches_done, '}') AS value FROM {behavior_score}""",
    "cdc_route": """
        SELECT CASE table_name WHEN 'crm.rfq' THEN 'crm.rfq_submitted' WHEN 'crm.sessions' THEN 'crm.buyer_sessions' WHEN 'crm.clicks' THEN 'crm.buyer_clicks' WHEN 'crm.leads' THEN 'crm.lead_updates' WHEN 'etl.kg_outbox' THEN 'kg.' || event_type
               ELSE table_name END AS topic, CASE WHEN table_name = 'etl.kg_outbox' THEN aggregate_id ELSE row_key END AS key, payload AS value FROM {changes}""",
}
