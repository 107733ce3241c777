"""Inputs of the streaming operators and views (SQL for Spark and DuckDB)."""

STREAM_FIXTURES: dict[str, str] = {
    "shipment_events": """
        SELECT CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) || '-' || CAST(l.l_partkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING) || '-' || CAST(l.l_extendedprice AS STRING) AS event_key,
               'B' || CAST(c.c_nationkey AS STRING) AS buyer_id, 'Buyer ' || nb.n_name AS buyer_name, 'S' || CAST(s.s_nationkey AS STRING) AS supplier_id,
               'Supplier ' || ns.n_name AS supplier_name, p.p_type || CAST(p.p_size % 2 AS STRING) AS hs_code, l.l_quantity AS quantity,
               l.l_extendedprice * (1 - l.l_discount) AS value, l.l_shipdate AS ship_date, TIMESTAMP '2024-01-31 00:00:00' AS _polled_at
        FROM {lineitem} AS l JOIN {orders} AS o ON l.l_orderkey = o.o_orderkey JOIN {customer} AS c ON o.o_custkey = c.c_custkey
        JOIN {supplier} AS s ON l.l_suppkey = s.s_suppkey JOIN {part} AS p ON l.l_partkey = p.p_partkey
        JOIN {nation} AS nb ON c.c_nationkey = nb.n_nationkey JOIN {nation} AS ns ON s.s_nationkey = ns.n_nationkey""",
    "web_events": """
        SELECT 'w' || CAST(event_id AS STRING) AS event_key, CASE k % 5 WHEN 0 THEN 'crm.buyer_clicks' WHEN 4 THEN 'crm.lead_updates' WHEN 3 THEN 'crm.rfq_submitted' ELSE 'crm.buyer_sessions' END AS topic,
               CASE k % 6 WHEN 0 THEN 'crm.page_event_trackings' WHEN 1 THEN 'crm.page_visits' WHEN 2 THEN 'crm.deals' WHEN 3 THEN 'crm.account_risk_flags' WHEN 4 THEN 'crm.sessions' ELSE 'crm.crm_leads' END AS _source_table,
               CAST(user_id AS STRING) AS user_id, CASE k % 4 WHEN 0 THEN 'getQuoteButton' WHEN 1 THEN 'contact-seller' ELSE '' END AS button_identity,
               CASE k % 7 WHEN 0 THEN 'catalog-download' WHEN 1 THEN 'x' ELSE NULL END AS element_name, CASE WHEN k % 9 = 0 THEN 'Get Quote' ELSE NULL END AS element_type,
               CASE k % 8 WHEN 0 THEN 'won' WHEN 1 THEN 'quoted' WHEN 2 THEN 'processed' WHEN 3 THEN '' ELSE 'new' END AS status, CASE WHEN k % 3 = 0 THEN 'hi' ELSE '' END AS message,
               CAST(event_id % 700 AS STRING) AS id, ts AS _polled_at FROM {activity}""",
    "emails": """
        SELECT event_id, 'lead:' || CAST(event_id % 2000 AS STRING) AS lead_uid, CASE event_type WHEN 'click' THEN 'Clicked' WHEN 'view' THEN 'open' WHEN 'error' THEN 'bounce' WHEN 'signup' THEN 'spam' ELSE 'sent' END AS event_type, ts AS at FROM {events}""",
    "account_leads": """
        SELECT lead_uid, lead_type, buyer_user_id AS account_uid, suppressed, TRUE AS seller_visible, distribution_status FROM {leads}""",
    "flag_events": "SELECT CAST(user_id AS STRING) AS account_uid, CASE WHEN k % 2 = 0 THEN 'spam' ELSE 'bot' END AS risk_type FROM {activity} WHERE event_type = 'error' AND user_id > 100",
    "identities": "SELECT CAST(user_id AS STRING) AS account_uid, max(value) AS confidence_score, 'Org ' || CAST(user_id AS STRING) AS organization_name FROM {events} WHERE user_id < 90 GROUP BY user_id",
    "masters": "SELECT lead_uid, 'open' AS status, score_final, suppressed AS is_suppressed FROM {leads} WHERE score_final > 60",
    "changes": """
        SELECT CASE event_id % 6 WHEN 0 THEN 'crm.rfq' WHEN 1 THEN 'crm.sessions' WHEN 2 THEN 'crm.clicks' WHEN 3 THEN 'crm.leads' WHEN 4 THEN 'etl.kg_outbox' ELSE 'crm.other' END AS table_name,
               event_type, 'agg' || CAST(user_id AS STRING) AS aggregate_id, props AS payload, CAST(event_id AS STRING) AS row_key, props AS row_json FROM {events}""",
    "lead_tags": """
        SELECT lead_uid, lead_type, priority, score_final, hs_code, CASE status_id WHEN 1 THEN 'trade_data,proactive_outreach,consolidation' ELSE NULL END AS playbook_tags FROM {leads}""",
}
