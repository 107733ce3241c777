"""DuckDB statements for versioned tables, streams into them and published messages: the batch answers."""

from leadloom.checks.sqltext import sid

STATE_FIXTURES: dict[str, str] = {
    "crm_events": """
        SELECT 'c' || CAST(event_id AS STRING) AS event_key, CASE WHEN k % 3 = 0 THEN 'crm.rfq_submitted' ELSE 'crm.lead_updates' END AS topic,
               CASE WHEN k % 3 = 0 THEN CASE k % 2 WHEN 0 THEN 'crm.rfqs' ELSE 'crm.enquiries' END
                    ELSE CASE event_id % 5 WHEN 0 THEN 'crm.deals' WHEN 1 THEN 'crm.account_risk_flags' WHEN 2 THEN 'crm.crm_emails' WHEN 3 THEN 'crm.account_identity' ELSE 'crm.crm_leads' END END AS _source_table,
               '' AS button_identity, '' AS element_name, CAST(event_id % 600 AS STRING) AS id,
               CASE k % 8 WHEN 0 THEN 'won' WHEN 1 THEN 'Quoted' WHEN 2 THEN 'processed' WHEN 3 THEN '' ELSE 'new' END AS status, CASE k % 5 WHEN 0 THEN 'Quote' WHEN 1 THEN 'bid' ELSE '' END AS enquiry_type,
               CASE WHEN k % 4 = 0 THEN 'hi' ELSE '' END AS message, CASE WHEN user_id > 90 THEN CAST(user_id AS STRING) ELSE '' END AS account_uid,
               CASE WHEN k % 2 = 0 THEN 'spam' ELSE 'bot' END AS risk_type, 'lead:' || CAST(event_id % 400 AS STRING) AS lead_uid,
               CASE k % 5 WHEN 0 THEN 'Clicked' WHEN 1 THEN 'open' WHEN 2 THEN 'bounce' WHEN 3 THEN 'spam' ELSE 'sent' END AS email_event, ts AS _polled_at FROM {activity}""",
}

STATE: dict[str, str] = {
    "versioned_nodes": """
        SELECT company_id, CASE WHEN company_id < '2' THEN lower(name) ELSE name END AS name, balance, origin, created_on, created_by, modified_on, modified_by FROM {new_table}
        UNION ALL SELECT company_id, name, balance, origin, created_on, created_by, modified_on, modified_by FROM {old_table} WHERE company_id NOT IN (SELECT company_id FROM {new_table})""",
    "outbox_replaced": f"""
        SELECT rel_id AS aggregate_id, {sid("'outbox'", "'trade_relationship.health_updated'", "rel_id")} AS event_id, 'trade_relationship.health_updated' AS event_type,
               CASE WHEN total_shipments > 5 THEN concat('{{"rel_id":"', rel_id, '","total_shipments":', total_shipments, '}}')
                    ELSE concat('{{"rel_id":"', rel_id, '","buyer_id":"', buyer_id, '","total_shipments":', total_shipments, '}}') END AS payload,
               CASE WHEN total_shipments > 5 THEN TIMESTAMP '2001-11-06 00:00:00' ELSE TIMESTAMP '2001-11-05 00:00:00' END AS created_at,
               total_shipments <= 5 AND substr(rel_id, 1, 1) < '8' AS processed FROM {{trade_relationships}}
        UNION ALL SELECT lead_id AS aggregate_id, {sid("'outbox'", "'switch_lead.upserted'", "lead_id")} AS event_id, 'switch_lead.upserted' AS event_type,
               concat('{{"lead_id":"', lead_id, '","buyer_id":"', buyer_id, '","lead_priority":"', lead_priority, '"}}') AS payload, TIMESTAMP '2001-11-05 00:00:00' AS created_at, FALSE AS processed
        FROM {{switch_leads_matched}}""",
    "stream_leads": """
        SELECT lead_id, opportunity_id, match_id, buyer_id, buyer_name, candidate_supplier_id, candidate_supplier_name, hs_code, stress_reason, switch_probability, match_score, final_lead_score, lead_priority,
               buyer_monthly_volume, recommended_action, contact_name, contact_title, contact_email, status FROM {switch_leads_matched}
        UNION ALL SELECT lead_id, opportunity_id, match_id, buyer_id, buyer_name, candidate_supplier_id, candidate_supplier_name, hs_code, stress_reason, switch_probability, match_score, final_lead_score, lead_priority,
               buyer_monthly_volume, recommended_action, contact_name, contact_title, contact_email, status FROM {switch_leads_unmatched}""",
    "sales_states": """
        SELECT *, CASE WHEN topic = 'crm.rfq_submitted' THEN CASE WHEN _source_table = 'crm.enquiries' THEN 'enquiry' ELSE 'rfq' END WHEN _source_table = 'crm.deals' THEN 'deal' ELSE 'crm_lead' END AS kind
        FROM {crm_events} WHERE topic = 'crm.rfq_submitted' OR _source_table IN ('crm.deals', 'crm.crm_leads')
        QUALIFY row_number() OVER (PARTITION BY kind, id ORDER BY _polled_at DESC, event_key DESC) = 1""",
    "stream_sales_leads": """
        WITH x AS (SELECT kind || ':' || id AS source_ref,
            CASE kind WHEN 'deal' THEN 'engaged_account' WHEN 'enquiry' THEN CASE WHEN enquiry_type = 'Quote' THEN 'quote_ready' ELSE 'rfq_submitted' END
                 WHEN 'rfq' THEN CASE status WHEN 'Quoted' THEN 'quote_ready' WHEN 'processed' THEN 'rfq_submitted' ELSE 'rfq_draft' END
                 ELSE CASE WHEN status = 'won' THEN 'quote_ready' WHEN message <> '' THEN 'known_account_interest' WHEN status <> '' THEN 'engaged_account' ELSE 'known_person_interest' END END AS lead_type,
            CASE kind WHEN 'deal' THEN 70 WHEN 'enquiry' THEN CASE enquiry_type WHEN 'Quote' THEN 90 WHEN 'bid' THEN 88 ELSE 85 END
                 WHEN 'rfq' THEN CASE status WHEN 'Quoted' THEN 90 WHEN 'processed' THEN 85 ELSE 65 END
                 ELSE CASE WHEN status = 'won' THEN 90 WHEN message <> '' THEN 68 WHEN status <> '' THEN 70 ELSE 68 END END AS score_final FROM {sales_states})
        SELECT source_ref, 'classified:' || lead_type || ':' || source_ref AS lead_uid, lead_type, score_final,
               CASE lead_type WHEN 'quote_ready' THEN 'instant_alert' WHEN 'rfq_submitted' THEN 'instant_alert' WHEN 'rfq_draft' THEN 'push_notify' WHEN 'engaged_account' THEN 'priority' ELSE 'feed' END AS visibility_level FROM x""",
    "stream_flagged_accounts": """
        SELECT l.lead_uid, l.suppressed OR (f.r IS NOT NULL AND l.lead_type <> 'suppressed_noise') AS suppressed,
               CASE WHEN f.r IS NOT NULL AND l.lead_type <> 'suppressed_noise' AND NOT l.suppressed THEN f.r END AS suppression_reason
        FROM {account_leads} AS l LEFT JOIN (SELECT account_uid, min(risk_type) AS r FROM {crm_events} WHERE topic = 'crm.lead_updates' AND _source_table = 'crm.account_risk_flags' AND account_uid <> ''
            GROUP BY account_uid) AS f ON f.account_uid = l.account_uid WHERE l.lead_type IS NOT NULL""",
    "stream_email_steps": """
        WITH RECURSIVE e AS (SELECT lead_uid, CASE WHEN email_event IN ('Clicked', 'open') THEN 5 ELSE -10 END AS d, row_number() OVER (PARTITION BY lead_uid ORDER BY _polled_at, event_key) AS n
            FROM {crm_events} WHERE topic = 'crm.lead_updates' AND _source_table = 'crm.crm_emails' AND email_event <> 'sent'),
        s AS (SELECT lead_uid, CAST(score_final AS BIGINT) AS x, 0 AS n FROM {leads} UNION ALL SELECT s.lead_uid, least(100, greatest(10, s.x + e.d)) AS x, e.n FROM s JOIN e ON e.lead_uid = s.lead_uid AND e.n = s.n + 1)
        SELECT lead_uid, arg_max(x, n) AS score_final FROM s GROUP BY lead_uid""",
    "published_messages": """
        WITH u AS (
          SELECT 'kg.switch_leads' AS topic, lead_id AS key, 'switch_lead.upserted' AS event_type, buyer_id AS buyer_org_id, CASE WHEN lead_priority = 'high' THEN 'sent' ELSE status END AS status, final_lead_score,
                 CAST(NULL AS DOUBLE) AS health_score, CAST(NULL AS BIGINT) AS total_shipments, CAST(NULL AS BIGINT) AS behavioral_score, CAST(NULL AS BIGINT) AS session_count, CAST(NULL AS BIGINT) AS rows FROM {switch_leads_matched}
          UNION ALL SELECT 'kg.trade_relationships', r.rel_id, 'trade_relationship.health_updated', r.buyer_id, NULL, NULL, h.health_score, r.total_shipments, NULL, NULL, NULL FROM {trade_relationships} AS r LEFT JOIN {health_status} AS h ON h.rel_id = r.rel_id
          UNION ALL SELECT 'kg.buyer_profiles', user_id, 'buyer_profile.score_updated', NULL, NULL, NULL, NULL, NULL, behavioral_score, total_sessions, NULL FROM {behavior_score}
          UNION ALL SELECT 'kg.pipeline_runs', 'run-' || o_orderstatus, 'pipeline.run_completed', NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*) FROM {orders} GROUP BY o_orderstatus)
        SELECT topic, key, event_type, '2024-01-31T00:00:00' AS event_time, buyer_org_id, status, final_lead_score, health_score, total_shipments, behavioral_score, session_count, rows,
               (SELECT count(*) FROM u) + (SELECT count(*) FROM {switch_leads_matched} WHERE lead_priority = 'high') AS messages FROM u""",
}
