"""Inputs of the platform-lead and behaviour operators (SQL for Spark and DuckDB)."""

_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"

PLATFORM_FIXTURES: dict[str, str] = {
    "activity": f"""
        SELECT event_id, ts, event_type, value, {_K} AS k, CASE WHEN user_id % 10 = 0 THEN 0 ELSE user_id END AS user_id,
               CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS session_id FROM {{events}}""",
    "sessions": """
        SELECT session_id, user_id, '10.0.0.' || CAST(user_id % 7 AS STRING) AS ip_address, 'agent/' || CAST(user_id % 5 AS STRING) AS user_agent,
               min(ts) AS created_at, CASE user_id % 5 WHEN 0 THEN 'NL' WHEN 1 THEN 'US' WHEN 2 THEN '' WHEN 3 THEN CASE WHEN min(event_id) % 2 = 0 THEN 'DE' ELSE 'AT' END ELSE NULL END AS country,
               CASE min(event_id) % 3 WHEN 0 THEN 'phone' WHEN 1 THEN 'desktop' ELSE NULL END AS device FROM {activity} GROUP BY session_id, user_id""",
    "clicks": """
        SELECT event_id AS id, session_id, CASE k % 12 WHEN 0 THEN 'Get Quote Now' WHEN 1 THEN ' Contact Supplier' WHEN 2 THEN 'Company Profile' WHEN 3 THEN 'Send a Query'
                 WHEN 4 THEN 'Get Quote' ELSE 'Other' END AS element_type, ts AS created_at FROM {activity} WHERE event_type = 'click'""",
    "scrolls": "SELECT session_id, CAST(event_id * 7 % 101 AS DOUBLE) AS average, ts AS created_at FROM {activity} WHERE event_type IN ('view', 'error')",
    "page_views": """
        SELECT event_id AS id, session_id, CASE k % 3 WHEN 0 THEN 'ProductDetail' WHEN 1 THEN 'Home' ELSE 'Category' END AS type, ts AS created_at,
               CASE WHEN k % 3 = 0 THEN 'p' || CAST(event_id % 40 AS STRING) ELSE NULL END AS product_id,
               CASE WHEN event_id % 20 = 0 THEN ts ELSE NULL END AS deleted_at FROM {activity} WHERE event_type IN ('view', 'purchase')""",
    "searches": """
        SELECT a.user_id, CASE WHEN a.event_id % 7 < 3 THEN 'certified goods with delivery and assembly: ' || p.p_name ELSE p.p_name END AS name, p.p_size AS category_id, a.event_id % 4 + 1 AS searched_total, a.ts AS created_at,
               CASE WHEN a.event_id % 13 = 0 THEN a.ts ELSE NULL END AS deleted_at
        FROM {activity} AS a JOIN {part} AS p ON p.p_partkey = a.k WHERE a.event_type IN ('error', 'view')""",
    "messages": "SELECT user_id, ts AS created_at FROM {activity} WHERE event_type = 'signup' AND k < 60",
    "enquiries": """
        SELECT a.event_id AS id, a.user_id % 60 AS enquiry_user_id, a.k AS seller_user_id, a.event_id % 90 AS product_id,
               CASE a.k % 5 WHEN 0 THEN 'quote' WHEN 1 THEN ' Bid' WHEN 2 THEN 'Seller Created' WHEN 3 THEN 'query' ELSE NULL END AS enquiry_type,
               d.text AS message, CASE WHEN a.k % 4 = 0 THEN 'NL' ELSE NULL END AS country,
               CASE a.k % 3 WHEN 0 THEN 'stone' WHEN 1 THEN 'glass' ELSE NULL END AS industry,
               CASE a.k % 6 WHEN 0 THEN 'Rival ' || CAST(a.k AS STRING) || repeat(' and partners', a.k % 24) WHEN 1 THEN '  ' ELSE NULL END AS competitor,
               CASE a.k % 9 WHEN 0 THEN 'We resell' WHEN 1 THEN 'Distribution of goods' WHEN 2 THEN 'WHOLESALE' WHEN 3 THEN 'resell, distribute' ELSE 'own use' END AS purpose_of_inquiry,
               a.ts AS created_at, CASE WHEN a.event_id % 17 = 0 THEN a.ts ELSE NULL END AS deleted_at
        FROM {activity} AS a LEFT JOIN {documents} AS d ON d.doc_id = a.event_id WHERE a.event_type = 'purchase'""",
    "rfqs": """
        SELECT o_orderkey AS rfq_id, CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey % 60 END AS user_id,
               CASE o_orderkey % 8 WHEN 0 THEN 'submitted' WHEN 1 THEN 'active' WHEN 2 THEN 'draft' WHEN 3 THEN 'processed' WHEN 4 THEN 'quoted' WHEN 5 THEN 'closed_won' WHEN 6 THEN 'open' ELSE NULL END AS status,
               o_orderdate AS created_at FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    "button_events": """
        SELECT CASE WHEN user_id = 0 THEN '' ELSE CAST(user_id AS STRING) END AS user_id,
               CASE k % 7 WHEN 0 THEN 'getQuoteButton' WHEN 1 THEN 'catalog-download' WHEN 2 THEN 'contact-seller' WHEN 3 THEN 'visit-store-link' WHEN 4 THEN '' ELSE 'scroll' END AS button_identity,
               ts AS created_at FROM {activity} WHERE event_type IN ('click', 'signup') AND k > 20""",
    "visits": """
        SELECT event_id AS id, user_id, CASE WHEN k % 4 = 0 THEN NULL ELSE chr(123) || '"utm_source":"s' || CAST(k % 3 AS STRING) || '","utm_campaign":"c' || CAST(k % 5 AS STRING) || '"' || chr(125) END AS utm_data,
               CAST(k AS DOUBLE) AS max_scroll_depth, value AS stay_on_page, event_id % 6 AS element_clicks FROM {activity} WHERE event_type = 'view'""",
    "leads": """
        SELECT 'lead:' || CAST(o_orderkey AS STRING) AS lead_uid,
               CASE o_orderkey % 16 WHEN 0 THEN NULL WHEN 1 THEN 'rfq_submitted' WHEN 2 THEN 'quote_ready' WHEN 3 THEN 'hot_in_market' WHEN 4 THEN 'engaged_person'
                 WHEN 5 THEN 'engaged_account' WHEN 6 THEN 'known_account_interest' WHEN 7 THEN 'intent_only' WHEN 8 THEN 'trade_buyer_candidate' WHEN 9 THEN 'cold_market'
                 WHEN 10 THEN 'visit_only' WHEN 11 THEN 'competitor_displacement' WHEN 12 THEN 'active_importer' WHEN 13 THEN 'strategic_account_watch' WHEN 14 THEN 'suppressed_noise' ELSE 'reactivation_candidate' END AS lead_type,
               40 + o_orderkey % 55 AS score_final, CASE o_orderkey % 4 WHEN 0 THEN 'feed' WHEN 1 THEN 'priority' WHEN 2 THEN 'instant_alert' ELSE 'push_notify' END AS visibility_level,
               CASE o_orderkey % 5 WHEN 0 THEN 'rfq:' || CAST(o_orderkey AS STRING) WHEN 1 THEN 'meeting:' || CAST(o_orderkey % 9000 AS STRING) WHEN 2 THEN 'deal:' || CAST(o_orderkey AS STRING)
                 WHEN 3 THEN 'crm2_session:' || CAST(o_custkey AS STRING) || '-2024-01-05' ELSE 'enquiry:' || CAST(o_orderkey % 9000 AS STRING) END AS source_ref,
               CASE WHEN o_orderkey % 3 = 0 THEN 'hello' WHEN o_orderkey % 3 = 1 THEN '' ELSE NULL END AS message,
               CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE NULL END AS status_id, CASE WHEN o_orderkey % 7 = 0 THEN TRUE ELSE NULL END AS score_override,
               CAST(o_custkey % 150 AS STRING) AS buyer_user_id, CASE WHEN o_orderkey % 6 = 0 THEN 'Buyer NATION_' || CAST(o_custkey % 12 AS STRING) ELSE NULL END AS company_name,
               CASE WHEN o_orderkey % 50 = 0 THEN 'B' || CAST(o_custkey % 5 AS STRING) ELSE NULL END AS buyer_org_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' ELSE 'medium' END AS priority, '68' AS hs_code, o_totalprice AS amount,
               o_orderdate AS classified_at, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate + INTERVAL '20' DAY END AS last_transition_at,
               CASE WHEN o_orderkey % 19 = 0 THEN TRUE ELSE FALSE END AS suppressed, CASE WHEN o_orderkey % 23 = 0 THEN 'suppressed' ELSE NULL END AS distribution_status,
               o_orderkey % 3 AS transition_count FROM {orders}""",
    "meetings": """
        SELECT event_id AS meeting_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS lead_id,
               CASE event_id % 4 WHEN 0 THEN 'h' || CAST(user_id AS STRING) || '@x.example' WHEN 1 THEN '' ELSE NULL END AS host_email FROM {activity} WHERE event_type = 'signup'""",
    "view_signals": """
        SELECT CASE WHEN user_id = 0 THEN '' ELSE 'U' || CAST(user_id AS STRING) END AS account_hint, session_id AS session_key, ts AS occurred_at
        FROM {activity} WHERE event_type IN ('view', 'click', 'error')""",
    "ghosts": "SELECT 'gp:' || session_id AS profile_id, 0.55 AS confidence FROM {sessions} WHERE user_id = 0",
    "buyer_details": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'Ann' END AS first_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS last_name,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'a@x.example' END AS email, c_mktsegment AS account_name, c_custkey AS buyer_id, c_nationkey AS crm_lead_id FROM {customer}""",
    "engagements": "SELECT event_id AS id, event_id % 500 AS lead_id, user_id FROM {activity} WHERE event_type = 'click'",
    "quotations": """
        SELECT o_orderkey AS id, o_orderpriority AS product_name, CASE o_orderkey % 5 WHEN 0 THEN 'Accepted' WHEN 1 THEN 'sent' WHEN 2 THEN 'DRAFT' WHEN 3 THEN NULL ELSE 'lost' END AS status,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS total_cost FROM {orders} WHERE o_orderstatus = 'F'""",
    "deals": """
        SELECT o_orderkey AS id, o_custkey, o_totalprice AS amount, TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '1' DAY * (o_orderkey % 200) AS created_at,
               TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '1' DAY * (o_orderkey % 50) AS updated_at FROM {orders}""",
    "risk_flags": """
        SELECT event_id AS id, CASE WHEN user_id = 0 THEN NULL ELSE user_id END AS account_uid,
               CASE k % 9 WHEN 0 THEN 'bot' WHEN 1 THEN 'spam' WHEN 2 THEN 'fake_rfq' WHEN 3 THEN 'duplicate' WHEN 4 THEN 'do_not_contact' ELSE 'late_payment' END AS risk_type,
               CASE WHEN k % 2 = 0 THEN 'high' ELSE NULL END AS severity FROM {activity} WHERE event_type = 'error'""",
    "platform_sellers": "SELECT 'S' || CAST(n_nationkey AS STRING) AS org_id, CAST(NULL AS STRING) AS name FROM {nation} WHERE n_nationkey < 6 UNION ALL SELECT CAST(NULL AS STRING) AS org_id, 'Supplier ' || n_name AS name FROM {nation} WHERE n_nationkey > 20",
}
