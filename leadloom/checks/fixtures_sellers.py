"""Inputs of the seller and feedback operators (SQL for Spark and DuckDB)."""

SELLER_FIXTURES: dict[str, str] = {
    "sellers": """
        SELECT 'SL' || CAST(s_suppkey AS STRING) AS seller_id, s_name AS name,
               CASE s_suppkey % 3 WHEN 0 THEN 'basic' WHEN 1 THEN 'professional' ELSE 'enterprise' END AS tier,
               CASE s_suppkey % 5 WHEN 0 THEN NULL ELSE split(CAST(60 + s_suppkey % 8 AS STRING) || ',' || CAST(60 + (s_suppkey + 3) % 8 AS STRING), ',') END AS hs_chapters,
               CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN split('NATION_' || CAST(s_suppkey % 25 AS STRING) || ',NATION_' || CAST((s_suppkey + 7) % 25 AS STRING), ',') ELSE split('*', ',') END AS target_countries,
               5 + s_suppkey % 20 AS max_leads_per_day, s_suppkey % 4 AS leads_today, floor(abs(s_acctbal) / 100) AS credits_available,
               s_suppkey % 11 <> 0 AS active, CASE WHEN s_suppkey % 2 = 0 THEN DATE '2024-01-31' ELSE DATE '2024-01-30' END AS leads_today_date
        FROM {supplier}""",
    "market_leads": """
        SELECT 'L' || CAST(o_orderkey AS STRING) AS lead_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium' WHEN '4-NOT SPECIFIED' THEN 'none' ELSE 'low' END AS priority,
               o_orderkey % 97 AS score, '[' || CAST(60 + o_custkey % 9 AS STRING) || '0299]' AS hs_code, 'nation_' || CAST(o_custkey % 25 AS STRING) AS buyer_country,
               CASE o_orderkey % 5 WHEN 0 THEN 'instant_alert' WHEN 1 THEN 'push_notify' WHEN 2 THEN 'feed' WHEN 3 THEN 'priority' ELSE NULL END AS visibility FROM {orders}""",
    "distribution_leads": """
        SELECT lead_uid AS lead_id, CASE WHEN score_final % 13 = 0 THEN 'blocked' ELSE lead_type END AS lead_type, CASE score_final % 4 WHEN 0 THEN FALSE WHEN 1 THEN NULL ELSE TRUE END AS seller_visible,
               CASE score_final % 6 WHEN 0 THEN 'distributed' WHEN 1 THEN 'pending' ELSE distribution_status END AS distribution_status FROM {leads}""",
    "assignments": """
        SELECT 'a' || CAST(o_orderkey AS STRING) AS assignment_id, 'SL' || CAST(o_custkey % 10 AS STRING) AS seller_id, 'lead:' || CAST(o_orderkey AS STRING) AS lead_id,
               CASE o_orderstatus WHEN 'F' THEN 'converted' WHEN 'O' THEN 'assigned' ELSE 'rejected' END AS status, o_orderdate AS assigned_at,
               o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 400 - 20) AS actioned_at, CAST(NULL AS STRING) AS action_notes,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 60 AS DOUBLE) END AS response_hours FROM {orders}""",
    "old_facts": "SELECT 'a' || CAST(o_orderkey AS STRING) AS assignment_id FROM {orders} WHERE o_orderpriority = '5-LOW'",
    "conversions": "SELECT 'SL' || CAST(o_custkey % 10 AS STRING) AS seller_id, o_orderkey FROM {orders} WHERE o_orderstatus = 'F'",
    "actions": """
        SELECT 'a' || CAST(event_id % 4000 AS STRING) AS assignment_id, CASE event_type WHEN 'view' THEN 'viewed' WHEN 'click' THEN 'contacted' WHEN 'purchase' THEN 'converted'
                 WHEN 'error' THEN 'rejected' ELSE 'waved' END AS action, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'n' || CAST(event_id AS STRING) END AS notes, ts AS recorded_at FROM {events}""",
    "feedback_log": """
        SELECT CASE event_id % 4 WHEN 0 THEN 'rfq_submitted' WHEN 1 THEN 'trade_buyer_candidate' WHEN 2 THEN 'buying_committee_active' ELSE 'warm_account' END AS lead_type,
               CASE WHEN event_id % 4 = 0 AND value > 10 THEN 'converted' WHEN event_id % 4 = 1 THEN CASE WHEN value > 3 THEN 'rejected' ELSE 'viewed' END
                    WHEN event_id % 4 = 2 AND value > 12 THEN 'converted' WHEN event_id % 4 = 3 AND value > 2 THEN 'rejected' ELSE 'viewed' END AS action, ts AS recorded_at FROM {events}""",
    "accounts": """
        SELECT 'SL' || CAST(s_suppkey AS STRING) AS seller_id, CAST(s_suppkey * 37 % 400 AS DOUBLE) AS credits_available, CAST(s_suppkey % 9 AS DOUBLE) AS credits_used_month,
               CAST(CASE s_suppkey % 3 WHEN 0 THEN 100 WHEN 1 THEN 500 ELSE -1 END AS DOUBLE) AS credits_total_month,
               CASE s_suppkey % 3 WHEN 0 THEN DATE '2024-01-01' WHEN 1 THEN DATE '2024-01-02' ELSE DATE '2023-12-01' END AS billing_cycle_start FROM {supplier}""",
    "transactions": """
        SELECT 'tx' || CAST(event_id AS STRING) AS tx_id, 'SL' || CAST(user_id % 60 AS STRING) AS seller_id, CASE WHEN event_type = 'purchase' THEN 'topup' ELSE 'deduct' END AS kind,
               CAST(CASE event_id % 3 WHEN 0 THEN 5 WHEN 1 THEN 3 ELSE 1 END AS DOUBLE) AS amount, ts AS at FROM {events}""",
    "given_sellers": """
        SELECT 'SL' || CAST(s_suppkey + 3 AS STRING) AS seller_id, CASE WHEN s_suppkey % 2 = 0 THEN 'New ' || s_name ELSE NULL END AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'enterprise' ELSE NULL END AS tier,
               CAST(NULL AS BIGINT) AS max_leads_per_day FROM {supplier} WHERE s_suppkey % 3 = 0""",
    "overrides": """
        SELECT 'lead:' || CAST(event_id % 3000 AS STRING) AS lead_uid, CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 100 END AS new_score, event_type AS reason,
               'U' || CAST(user_id AS STRING) AS changed_by, ts AS changed_at FROM {events} WHERE user_id < 50""",
    "overridable": """
        SELECT lead_uid, lead_type, score_final, CASE WHEN score_override THEN score_final - 7 ELSE NULL END AS score_final_original, score_override FROM {leads}""",
    "overridden_nodes": """
        SELECT 'BuyerProfile' AS kind, 'buyer_profile:' || CAST(event_id AS STRING) AS key, event_type AS sub, CAST(event_id % 60 AS DOUBLE) AS original, CAST(event_id % 100 AS DOUBLE) AS score, event_id % 7 = 0 AS hand,
               'r' || CAST(event_id % 5 AS STRING) AS reason, 'U' || CAST(user_id AS STRING) AS changed_by, ts AS changed_at FROM {events} WHERE event_id < 3000
        UNION ALL SELECT 'TradeRelationship' AS kind, 'rel' || CAST(o_orderkey AS STRING) AS key, o_orderstatus AS sub, CAST(o_orderkey % 90 AS DOUBLE) AS original, CAST(o_orderkey % 80 AS DOUBLE) AS score, o_orderkey % 9 = 1 AS hand,
               o_orderpriority AS reason, 'C' || CAST(o_custkey AS STRING) AS changed_by, o_orderdate AS changed_at FROM {orders}
        UNION ALL SELECT 'SwitchLead' AS kind, 'sl' || CAST(c_custkey AS STRING) AS key, c_mktsegment AS sub, CAST(NULL AS DOUBLE) AS original, c_acctbal AS score, c_custkey % 3 = 0 AS hand,
               CAST(NULL AS STRING) AS reason, c_name AS changed_by, TIMESTAMP '2024-01-01 00:00:00' AS changed_at FROM {customer}""",
}
