"""DuckDB statements for platform leads and behaviour profiles."""

from leadloom.checks.oracle_views import CLICK_BUTTONS, CLICK_ELEMENTS
from leadloom.checks.sqltext import quoted, values_table

# Fixed values, written here again so that a wrong one in an operator shows: score, visibility and tags by lead type.
_SCORES = [
    ("rfq_submitted", 85), ("rfq_draft", 65), ("quote_ready", 90), ("engaged_person", 75), ("engaged_account", 70),
    ("known_account_interest", 68), ("hot_in_market", 72), ("intent_only", 55), ("active_importer", 60), ("visit_only", 40),
    ("anonymous_account_visit", 30), ("trade_buyer_candidate", 62), ("strategic_account_watch", 65), ("competitor_displacement", 80), ("known_person_interest", 70),
    ("reactivation_candidate", 72), ("partner_chain_opportunity", 68), ("suppressed_noise", 10), ("active_exporter", 60),
]
_VISIBILITY = [
    ("rfq_submitted", "instant_alert"), ("quote_ready", "instant_alert"), ("hot_in_market", "instant_alert"), ("rfq_draft", "push_notify"),
    ("competitor_displacement", "push_notify"), ("switch_lead", "push_notify"), ("engaged_person", "priority"), ("engaged_account", "priority"),
    ("active_importer", "priority"), ("trade_buyer_candidate", "priority"), ("known_account_interest", "feed"), ("known_person_interest", "feed"),
    ("intent_only", "feed"), ("strategic_account_watch", "watchlist"), ("anonymous_account_visit", "watchlist"), ("visit_only", "count_only"),
    ("reactivation_candidate", "push_notify"), ("partner_chain_opportunity", "feed"), ("suppressed_noise", "count_only"), ("active_exporter", "feed"),
]
_TAGS = [
    ("rfq_submitted", "rfq_respond_now,procurement_response"), ("quote_ready", "rfq_respond_now,commercial_path"),
    ("hot_in_market", "high_intent_abandonment,account_warming"), ("competitor_displacement", "champion_reengagement,commercial_path"),
    ("engaged_person", "contact_qualification,buying_committee_velocity"), ("engaged_account", "account_warming,contact_qualification"),
    ("known_person_interest", "contact_qualification,outbound_trade"), ("known_account_interest", "account_warming"),
    ("active_importer", "outbound_trade,procurement_response"), ("trade_buyer_candidate", "supply_chain_resilience,outbound_trade"),
    ("intent_only", "account_warming,high_intent_abandonment"), ("strategic_account_watch", "strategic_consolidation,ecosystem_play"),
    ("reactivation_candidate", "champion_reengagement,contact_moved_to_new_company"), ("partner_chain_opportunity", "ecosystem_play,cross_sell"),
    ("active_exporter", "ecosystem_play,strategic_consolidation"),
]
_scores, _vis, _tags = values_table("t, s", _SCORES), values_table("t, v", _VISIBILITY), values_table("t, tags", _TAGS)
_elements = values_table("name, w", CLICK_ELEMENTS)
_buttons = values_table("name, w", CLICK_BUTTONS)


def lead(body: str) -> str:
    """Common columns around rows with lead_type, source_ref, source and own columns."""
    return f"""SELECT 'classified:' || x.lead_type || ':' || x.source_ref AS lead_uid, s.s AS score_default, v.v AS visibility_default, x.*
        FROM ({body}) AS x JOIN (SELECT * FROM {_scores}) AS s ON s.t = x.lead_type JOIN (SELECT * FROM {_vis}) AS v ON v.t = x.lead_type
        WHERE x.source_ref NOT IN (SELECT source_ref FROM {{leads}})"""


def std(body: str, extra: str = "", score: str = "score_default", vis: str = "visibility_default") -> str:
    return f"SELECT lead_uid, lead_type, {score} AS score_final, {vis} AS visibility_level, source, source_ref{', ' + extra if extra else ''} FROM ({lead(body)}) AS y"


_enq = "(SELECT * EXCLUDE (enquiry_type), lower(trim(coalesce(enquiry_type, ''))) AS e FROM {enquiries} WHERE deleted_at IS NULL) AS q"
_owned = "(SELECT * FROM {sessions} WHERE user_id > 0)"

PLATFORM: dict[str, str] = {
    "reclassify_untyped": """
        SELECT lead_uid, CASE WHEN ch THEN CASE WHEN message <> '' THEN 'known_account_interest' WHEN status_id IS NOT NULL THEN 'engaged_account' ELSE 'known_person_interest' END ELSE lead_type END AS lead_type,
               CASE WHEN ch THEN CASE WHEN message <> '' THEN 68 ELSE 70 END ELSE score_final END AS score_final,
               CASE WHEN ch THEN CASE WHEN message <> '' THEN 'feed' WHEN status_id IS NOT NULL THEN 'priority' ELSE 'feed' END ELSE visibility_level END AS visibility_level,
               CASE WHEN ch THEN TIMESTAMP '2024-01-31 00:00:00' ELSE classified_at END AS classified_at
        FROM (SELECT *, lead_type IS NULL AND coalesce(score_override, FALSE) = FALSE AS ch FROM {leads}) AS x""",
    "promote_cold_market": """
        SELECT lead_uid, CASE WHEN lead_type = 'cold_market' THEN 'active_importer' ELSE lead_type END AS lead_type,
               CASE WHEN lead_type = 'cold_market' THEN 60 ELSE score_final END AS score_final, CASE WHEN lead_type = 'cold_market' THEN 'priority' ELSE visibility_level END AS visibility_level,
               CASE WHEN lead_type = 'cold_market' THEN TIMESTAMP '2024-01-31 00:00:00' ELSE classified_at END AS classified_at FROM {leads}""",
    "rfq_leads": std(f"""SELECT CASE WHEN status IN ('processed', 'processing', 'health_check_process') THEN 'rfq_submitted' WHEN status IN ('quoted', 'approved', 'closed_won') THEN 'quote_ready' ELSE 'rfq_draft' END AS lead_type,
        'rfq:' || rfq_id AS source_ref, 'app_crm' AS source, rfq_id, status FROM {{rfqs}}""", "rfq_id, status"),
    "meeting_leads": std("""SELECT 'engaged_account' AS lead_type, 'meeting:' || meeting_id AS source_ref, 'app_crm' AS source, meeting_id, host_email FROM {meetings} WHERE lead_id IS NOT NULL
        UNION ALL SELECT 'engaged_person' AS lead_type, 'meeting_person:' || meeting_id AS source_ref, 'app_crm' AS source, meeting_id, host_email FROM {meetings} WHERE lead_id IS NULL AND host_email <> ''""",
        "meeting_id, host_email"),
    "pageview_leads": std("""SELECT 'visit_only' AS lead_type, 'visit_only:sess:' || session_key AS source_ref, 'app_website' AS source, account_hint, count(*) AS pageview_count,
        min(occurred_at) AS first_seen, max(occurred_at) AS last_seen FROM {view_signals} WHERE account_hint <> '' GROUP BY account_hint, session_key""",
        "account_hint, pageview_count, first_seen, last_seen", "CASE WHEN pageview_count >= 5 THEN 50 ELSE 40 END", "CASE WHEN pageview_count >= 5 THEN 'priority' ELSE 'count_only' END"),
    "anonymous_leads": std("SELECT 'anonymous_account_visit' AS lead_type, 'ghost:' || profile_id AS source_ref, 'app_website' AS source, profile_id, confidence FROM {ghosts}", "profile_id, confidence"),
    "intent_leads": std("""SELECT 'hot_in_market' AS lead_type, 'hot_in_market:acct:' || account_hint AS source_ref, 'app_intelligence' AS source, account_hint, count(*) AS trigger_count, max(occurred_at) AS last_seen
          FROM {signals} WHERE signal_type = 'news_trigger_detected' AND account_hint <> '' GROUP BY account_hint
        UNION ALL SELECT 'intent_only' AS lead_type, 'intent_only:acct:' || account_hint AS source_ref, 'app_intent' AS source, account_hint, CAST(NULL AS BIGINT) AS trigger_count, max(occurred_at) AS last_seen
          FROM {signals} WHERE signal_type = 'third_party_intent_detected' AND account_hint <> '' GROUP BY account_hint""", "account_hint, trigger_count, last_seen"),
    "trade_buyer_leads": std("""SELECT DISTINCT 'trade_buyer_candidate' AS lead_type, 'trade_buyer:' || coalesce(account_hint, signal_uid) AS source_ref, 'app_trade' AS source,
        coalesce(account_hint, signal_uid) AS account_key FROM {signals} WHERE signal_type = 'active_importer_detected'""", "account_key"),
    "engaged_person_leads": std("""SELECT 'engaged_person' AS lead_type, 'buyer_detail:' || id AS source_ref, 'app_crm' AS source, trim(first_name || ' ' || coalesce(last_name, '')) AS contact_name,
          coalesce(email, '') AS contact_email, account_name AS company_name, CAST(buyer_id AS VARCHAR) AS buyer_user_id, CAST(crm_lead_id AS VARCHAR) AS crm_lead_id, 75 AS sc FROM {buyer_details} WHERE first_name <> ''
        UNION ALL SELECT 'engaged_person' AS lead_type, 'lead_engagement:' || id AS source_ref, 'app_crm' AS source, '' AS contact_name, '' AS contact_email, '' AS company_name,
          CAST(user_id AS VARCHAR) AS buyer_user_id, CAST(lead_id AS VARCHAR) AS crm_lead_id, 70 AS sc FROM {engagements} WHERE user_id > 0""",
        "contact_name, contact_email, company_name, buyer_user_id, crm_lead_id", "sc"),
    "quotation_leads": std("""SELECT CASE WHEN st IN ('accepted', 'sent') THEN 'quote_ready' ELSE 'rfq_submitted' END AS lead_type, 'quotation:' || id AS source_ref, 'app_crm' AS source, product_name,
        coalesce(total_cost, 0) AS total_cost, st AS quotation_status FROM (SELECT *, lower(coalesce(status, '')) AS st FROM {quotations}) AS q""", "product_name, total_cost, quotation_status",
        "CASE quotation_status WHEN 'accepted' THEN 95 WHEN 'sent' THEN 85 WHEN 'initiated' THEN 75 WHEN 'draft' THEN 75 ELSE 70 END", "'instant_alert'"),
    "enquiry_leads": std(f"""SELECT CASE e WHEN 'quote' THEN 'quote_ready' WHEN 'seller created' THEN 'engaged_account' ELSE 'rfq_submitted' END AS lead_type, 'enquiry:' || id AS source_ref, 'app_crm2' AS source,
        CAST(enquiry_user_id AS VARCHAR) AS buyer_user_id, CAST(seller_user_id AS VARCHAR) AS seller_user_id, coalesce(message, '') AS message, coalesce(country, '') AS buyer_country,
        CAST(product_id AS VARCHAR) AS product_id, coalesce(industry, '') AS buyer_industry, coalesce(competitor, '') AS competitor, e, e AS enquiry_type FROM {_enq}""",
        "buyer_user_id, seller_user_id, product_id, message, buyer_country, buyer_industry, competitor, enquiry_type",
        "CASE e WHEN 'quote' THEN 90 WHEN 'bid' THEN 88 WHEN 'seller created' THEN 70 ELSE 85 END"),
    "session_leads": std("""SELECT CASE WHEN user_id > 0 THEN 'visit_only' ELSE 'anonymous_account_visit' END AS lead_type, 'crm2_session:' || session_id AS source_ref, 'app_website_crm2' AS source, * FROM (
          SELECT v.session_id, coalesce(s.user_id, 0) AS user_id, count(*) AS pageview_count, count(*) FILTER (WHERE v.type = 'ProductDetail') AS product_views,
                 string_agg(DISTINCT v.type, ',' ORDER BY v.type) AS page_types, min(v.created_at) AS first_seen, max(v.created_at) AS last_seen
          FROM {page_views} AS v LEFT JOIN {sessions} AS s ON v.session_id = s.session_id WHERE v.deleted_at IS NULL GROUP BY v.session_id, s.user_id) AS g""",
        "session_id, user_id, pageview_count, product_views, page_types, first_seen, last_seen",
        "CASE WHEN user_id = 0 THEN 30 WHEN pageview_count >= 3 OR product_views >= 1 THEN 50 ELSE 40 END",
        "CASE WHEN user_id = 0 THEN 'watchlist' WHEN pageview_count >= 3 THEN 'priority' ELSE 'count_only' END"),
    "search_leads": std("""SELECT 'intent_only' AS lead_type, 'search:' || user_id || ':' || CASE WHEN length(name) <= 40 THEN name ELSE 'md5:' || md5(name) END AS source_ref, 'app_search' AS source, user_id, name AS keyword, CAST(min(category_id) AS VARCHAR) AS category_id,
        CAST(sum(searched_total) AS BIGINT) AS search_count, max(created_at) AS last_searched FROM {searches} WHERE deleted_at IS NULL AND user_id > 0 GROUP BY user_id, name""",
        "user_id, keyword, category_id, search_count, last_searched", "55 + least(2 * search_count, 20)"),
    "competitor_leads": std("""SELECT 'competitor_displacement' AS lead_type, 'competitor_enquiry:' || id AS source_ref, 'app_crm2' AS source, CAST(enquiry_user_id AS VARCHAR) AS buyer_user_id,
        CAST(seller_user_id AS VARCHAR) AS seller_user_id, CAST(product_id AS VARCHAR) AS product_id, competitor AS current_supplier, coalesce(message, '') AS message, coalesce(country, '') AS buyer_country,
        lower(coalesce(enquiry_type, '')) AS enquiry_type FROM {enquiries} WHERE deleted_at IS NULL AND trim(competitor) <> ''""",
        "buyer_user_id, seller_user_id, product_id, current_supplier, message, buyer_country, enquiry_type"),
    "relations_watched": """
        SELECT r.rel_id, r.buyer_id, r.buyer_name, r.supplier_id, r.supplier_name, r.total_shipments, r.baseline_avg_value AS buyer_monthly_volume, h.health_score
        FROM {trade_relationships} AS r LEFT JOIN {health_status} AS h ON r.rel_id = h.rel_id""",
    "strategic_watch": std("""SELECT 'strategic_account_watch' AS lead_type, 'strategic_watch:' || buyer_id AS source_ref, 'app_trade' AS source, buyer_name AS company_name, buyer_id AS buyer_org_id,
          max(buyer_monthly_volume) AS buyer_monthly_volume, max(health_score) AS trade_health_score, count(*) AS trade_relationship_count FROM {relations_watched} AS w
        WHERE buyer_monthly_volume >= 10000 AND NOT EXISTS (SELECT 1 AS one FROM {leads} AS l WHERE (l.buyer_org_id = w.buyer_id OR l.company_name = w.buyer_name) AND l.score_final >= 70)
          AND buyer_id NOT IN (SELECT buyer_id FROM {opps_rules} WHERE stress_score >= 95 AND buyer_monthly_volume > 70) GROUP BY buyer_id, buyer_name""",
        "company_name, buyer_org_id, buyer_monthly_volume, trade_health_score, trade_relationship_count"),
    "reactivation_leads": std("""SELECT 'reactivation_candidate' AS lead_type, 'deal:' || id AS source_ref, 'app_crm' AS source, amount AS deal_amount FROM {deals}
        WHERE updated_at > TIMESTAMP '2024-01-01 00:00:00' AND created_at < TIMESTAMP '2023-11-02 00:00:00'""", "deal_amount"),
    "partner_leads": std("""SELECT 'partner_chain_opportunity' AS lead_type, 'enquiry_partner:' || id AS source_ref, 'app_crm2' AS source,
          CASE WHEN contains(w, 'distribut') THEN 'distributor' WHEN contains(w, 'wholesale') THEN 'wholesaler' ELSE 'reseller' END AS partner_type,
          CAST(enquiry_user_id AS VARCHAR) AS buyer_user_id, coalesce(country, '') AS buyer_country
        FROM (SELECT *, lower(coalesce(purpose_of_inquiry, '')) || ' ' || lower(coalesce(message, '')) AS w FROM {enquiries} WHERE deleted_at IS NULL) AS q
        WHERE contains(w, 'distribut') OR contains(w, 'wholesale') OR contains(w, 'resell')""", "partner_type, buyer_user_id, buyer_country"),
    "noise_leads": std(f"""SELECT 'suppressed_noise' AS lead_type, 'risk_flag:' || id AS source_ref, 'crm_risk' AS source, coalesce(CAST(account_uid AS VARCHAR), '') AS account_uid, risk_type AS suppression_reason,
        coalesce(severity, 'medium') AS risk_severity, TRUE AS suppressed, FALSE AS seller_visible, 'suppressed' AS distribution_status FROM {{risk_flags}} WHERE risk_type IN ('bot', 'spam', 'fake_rfq', 'duplicate', 'tracking_anomaly', 'compliance_risk', 'do_not_contact')""",
        "account_uid, suppression_reason, risk_severity, suppressed, seller_visible, distribution_status"),
    "exporter_leads": std("""SELECT 'active_exporter' AS lead_type, 'active_exporter:' || supplier_id AS source_ref, 'app_trade' AS source, supplier_name AS company_name, supplier_id AS buyer_org_id,
          count(*) AS trade_relationship_count, avg(health_score) AS avg_trade_health, CAST(sum(total_shipments) AS BIGINT) AS total_shipments FROM {relations_watched} AS w
        WHERE NOT EXISTS (SELECT 1 AS one FROM {platform_sellers} AS s WHERE s.org_id = w.supplier_id OR s.name = w.supplier_name) GROUP BY supplier_id, supplier_name HAVING count(*) >= 3""",
        "company_name, buyer_org_id, trade_relationship_count, avg_trade_health, total_shipments"),
    "playbook_tags": f"SELECT l.lead_uid, l.lead_type, CASE WHEN l.status_id IS NOT NULL THEN 'own' ELSE coalesce(t.tags, '') END AS playbook_tags FROM {{leads}} AS l LEFT JOIN (SELECT * FROM {_tags}) AS t ON t.t = l.lead_type",
    "lead_type_distribution": """
        SELECT lead_type, count(*) AS leads FROM {leads} GROUP BY lead_type UNION ALL SELECT 'switch_lead' AS lead_type, count(*) AS leads FROM {opps_rules}
        UNION ALL SELECT 'total' AS lead_type, (SELECT count(*) FROM {leads}) + (SELECT count(*) FROM {opps_rules}) AS leads""",
    # --- behaviour ---------------------------------------------------------------------------------
    "click_weights": f"SELECT c.id, c.element_type, coalesce(e.w, 0) AS weight FROM {{clicks}} AS c LEFT JOIN (SELECT * FROM {_elements}) AS e ON e.name = trim(c.element_type)",
    "button_rows": f"""
        SELECT CAST(o.user_id AS VARCHAR) AS user_id, trim(c.element_type) AS button, coalesce(e.w, 0) AS w, CAST(NULL AS TIMESTAMP) AS seen_at
        FROM {{clicks}} AS c JOIN {_owned} AS o ON c.session_id = o.session_id LEFT JOIN (SELECT * FROM {_elements}) AS e ON e.name = trim(c.element_type)
        UNION ALL SELECT b.user_id, b.button_identity AS button, coalesce(e.w, 0) AS w, b.created_at AS seen_at FROM {{button_events}} AS b LEFT JOIN (SELECT * FROM {_buttons}) AS e ON e.name = b.button_identity
        WHERE b.user_id <> '' AND b.button_identity <> ''""",
    "buyer_profiles": f"""
        WITH u AS (SELECT CAST(user_id AS VARCHAR) AS user_id FROM {_owned} AS o UNION SELECT user_id FROM {{button_rows}}
            UNION SELECT CAST(enquiry_user_id AS VARCHAR) AS user_id FROM {{enquiries}} WHERE deleted_at IS NULL AND enquiry_user_id > 0
            UNION SELECT CAST(user_id AS VARCHAR) AS user_id FROM {{searches}} WHERE deleted_at IS NULL AND user_id > 0 UNION SELECT CAST(user_id AS VARCHAR) AS user_id FROM {{messages}} WHERE user_id > 0
            UNION SELECT CAST(user_id AS VARCHAR) AS user_id FROM {{rfqs}} WHERE user_id IS NOT NULL),
        se AS (SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS n, max(created_at) AS l FROM {_owned} AS o GROUP BY user_id),
        bu AS (SELECT user_id, count(*) AS n, sum(w) AS w, max(seen_at) AS l FROM {{button_rows}} GROUP BY user_id),
        bd AS (SELECT user_id, string_agg(button || ':' || n, '|' ORDER BY n DESC, button) AS d FROM (SELECT user_id, button, count(*) AS n FROM {{button_rows}} WHERE w > 0 GROUP BY user_id, button) AS x GROUP BY user_id),
        sc AS (SELECT CAST(o.user_id AS VARCHAR) AS user_id, count(*) FILTER (WHERE d >= 75) AS n, max(d) AS d FROM (SELECT session_id, max(average) AS d FROM {{scrolls}} GROUP BY session_id) AS x JOIN {_owned} AS o ON o.session_id = x.session_id GROUP BY o.user_id),
        pv AS (SELECT CAST(o.user_id AS VARCHAR) AS user_id, count(*) AS n, count(*) FILTER (WHERE v.type = 'ProductDetail') AS p, max(v.created_at) AS l FROM {{page_views}} AS v JOIN {_owned} AS o ON o.session_id = v.session_id WHERE v.deleted_at IS NULL GROUP BY o.user_id),
        en AS (SELECT CAST(enquiry_user_id AS VARCHAR) AS user_id, count(*) AS n, count(*) FILTER (WHERE enquiry_type = 'quote') AS q, max(created_at) AS l FROM {{enquiries}} WHERE deleted_at IS NULL AND enquiry_user_id > 0 GROUP BY enquiry_user_id),
        sw AS (SELECT CAST(user_id AS VARCHAR) AS user_id, name, sum(searched_total) AS n, max(searched_total) AS m FROM {{searches}} WHERE deleted_at IS NULL AND user_id > 0 GROUP BY user_id, name),
        sr AS (SELECT user_id, sum(n) AS n FROM sw GROUP BY user_id),
        sk AS (SELECT user_id, list(keyword ORDER BY rk) AS k FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY most_at_once DESC, keyword) AS rk FROM {{profile_keywords}}) AS x WHERE rk <= 12 GROUP BY user_id),
        pc AS (SELECT user_id, count(*) AS n FROM {{profile_products}} GROUP BY user_id),
        pt AS (SELECT user_id, list(product_id ORDER BY rk) AS k FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY views DESC, product_id) AS rk FROM {{profile_products}}) AS x WHERE rk <= 20 GROUP BY user_id),
        co AS (SELECT CAST(user_id AS VARCHAR) AS user_id, list(DISTINCT country ORDER BY country) AS k FROM {{sessions}} WHERE user_id > 0 AND country <> '' GROUP BY user_id),
        de AS (SELECT CAST(user_id AS VARCHAR) AS user_id, list(DISTINCT device ORDER BY device) AS k FROM {{sessions}} WHERE user_id > 0 AND device <> '' GROUP BY user_id),
        me AS (SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS n FROM {{messages}} WHERE user_id > 0 GROUP BY user_id),
        rf AS (SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) FILTER (WHERE status IN ('submitted', 'active', 'open')) AS n, count(*) FILTER (WHERE status = 'submitted') AS q, max(created_at) AS l FROM {{rfqs}} WHERE user_id IS NOT NULL GROUP BY user_id)
        SELECT u.user_id, 'buyer_profile:' || u.user_id AS profile_uid, coalesce(se.n, 0) AS total_sessions, coalesce(pv.n, 0) AS total_page_views, coalesce(pv.p, 0) AS product_page_views, coalesce(bu.n, 0) AS total_clicks,
               coalesce(bu.w, 0) AS high_intent_score, coalesce(sc.n, 0) AS sessions_deep_scroll, coalesce(en.n, 0) + coalesce(rf.n, 0) AS enquiries_sent, coalesce(en.q, 0) + coalesce(rf.q, 0) AS quote_requests,
               coalesce(me.n, 0) AS messages_sent, coalesce(sr.n, 0) AS searches_done, coalesce(sc.d, 0) AS max_scroll_depth, greatest(se.l, bu.l, pv.l, en.l, rf.l) AS last_activity_at,
               en.user_id IS NOT NULL OR rf.user_id IS NOT NULL AS has_enquiry, coalesce(bd.d, '') AS high_intent_detail, coalesce(sk.k, []) AS search_keywords,
               coalesce(pc.n, 0) AS products_viewed_count, coalesce(pt.k, []) AS products_top, coalesce(co.k, []) AS buyer_countries, coalesce(de.k, []) AS buyer_devices
        FROM u LEFT JOIN se ON se.user_id = u.user_id LEFT JOIN bu ON bu.user_id = u.user_id LEFT JOIN bd ON bd.user_id = u.user_id LEFT JOIN sc ON sc.user_id = u.user_id LEFT JOIN pv ON pv.user_id = u.user_id
        LEFT JOIN en ON en.user_id = u.user_id LEFT JOIN sr ON sr.user_id = u.user_id LEFT JOIN me ON me.user_id = u.user_id LEFT JOIN rf ON rf.user_id = u.user_id
        LEFT JOIN sk ON sk.user_id = u.user_id LEFT JOIN pc ON pc.user_id = u.user_id LEFT JOIN pt ON pt.user_id = u.user_id LEFT JOIN co ON co.user_id = u.user_id LEFT JOIN de ON de.user_id = u.user_id""",
    "profile_keywords": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, name AS keyword, CAST(sum(searched_total) AS BIGINT) AS searches, max(searched_total) AS most_at_once
        FROM {searches} WHERE deleted_at IS NULL AND user_id > 0 AND name IS NOT NULL GROUP BY user_id, name""",
    "profile_products": """
        SELECT CAST(s.user_id AS VARCHAR) AS user_id, v.product_id, count(*) AS views FROM {page_views} AS v JOIN {sessions} AS s ON s.session_id = v.session_id
        WHERE v.type = 'ProductDetail' AND v.deleted_at IS NULL AND v.product_id <> '' AND s.user_id > 0 GROUP BY s.user_id, v.product_id""",
    "behavior_score": """
        SELECT *, least(100, 30 + least(8 * enquiries_sent, 40) + least(2 * high_intent_score, 20) + least(2 * total_sessions, 10) + least(2 * sessions_deep_scroll, 8) + least(searches_done, 5) + least(3 * messages_sent, 9)) AS behavioral_score
        FROM {buyer_profiles}""",
    "profile_lead_type": """
        SELECT *, CASE WHEN enquiries_sent > 0 AND quote_requests > 0 THEN 'quote_ready' WHEN enquiries_sent > 0 THEN 'rfq_submitted' WHEN high_intent_score >= 6 OR messages_sent > 0 THEN 'engaged_person'
                 WHEN high_intent_score >= 2 THEN 'known_account_interest' ELSE 'visit_only' END AS lead_type_signal,
               CASE WHEN enquiries_sent > 0 AND quote_requests > 0 THEN least(behavioral_score + 5, 100) WHEN enquiries_sent > 0 THEN behavioral_score WHEN high_intent_score >= 6 OR messages_sent > 0 THEN least(behavioral_score, 80)
                 WHEN high_intent_score >= 2 THEN least(behavioral_score, 70) WHEN product_page_views >= 3 OR total_sessions >= 2 THEN greatest(behavioral_score, 40) ELSE 40 END AS lead_score FROM {behavior_score}""",
    "click_intent_leads": """
        SELECT 'behavioral:' || lead_type_signal || ':click_behavior:' || user_id AS lead_uid, lead_type_signal AS lead_type, lead_score AS score_final, 'seller_visible' AS visibility_level, 'app_behavior' AS source,
               'click_behavior:' || user_id AS source_ref, user_id AS buyer_user_id, high_intent_score, high_intent_detail AS click_detail, behavioral_score
        FROM {profile_lead_type} WHERE NOT has_enquiry AND high_intent_score >= 2 AND lead_type_signal <> 'visit_only'""",
    "enrich_leads_with_behavior": """
        SELECT l.lead_uid, l.buyer_user_id, CASE WHEN f THEN p.behavioral_score END AS behavioral_score, CASE WHEN f THEN p.high_intent_score END AS high_intent_score, CASE WHEN f THEN p.total_sessions END AS total_sessions,
               CASE WHEN f THEN p.profile_uid END AS profile_uid
        FROM (SELECT *, coalesce(score_override, FALSE) = FALSE AS f FROM {leads}) AS l LEFT JOIN {behavior_score} AS p ON p.user_id = l.buyer_user_id""",
    "behavior_summary": """
        SELECT count(*) AS total_profiles, round(avg(behavioral_score), 1) AS avg_score, count(*) FILTER (WHERE behavioral_score >= 70) AS high_intent, count(*) FILTER (WHERE enquiries_sent > 0) AS enquiry_buyers,
               count(*) FILTER (WHERE high_intent_score >= 6) AS strong_clickers, count(*) FILTER (WHERE sessions_deep_scroll >= 1) AS deep_readers, count(*) FILTER (WHERE messages_sent > 0) AS chatted FROM {behavior_score}""",
    "top_engaged": "SELECT user_id, behavioral_score, high_intent_detail FROM {behavior_score} WHERE high_intent_detail <> '' ORDER BY behavioral_score DESC, user_id LIMIT 5",
    "visit_facts": """
        SELECT coalesce(json_extract_string(utm_data, '$.utm_source'), '') AS utm_source, coalesce(json_extract_string(utm_data, '$.utm_campaign'), '') AS utm_campaign, count(*) AS visits, count(DISTINCT user_id) AS users,
               avg(max_scroll_depth) AS mean_scroll_depth, avg(stay_on_page) AS mean_stay, CAST(sum(element_clicks) AS BIGINT) AS clicks FROM {visits} GROUP BY 1, 2""",
}
