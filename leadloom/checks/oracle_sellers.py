"""DuckDB statements for sellers and feedback."""

from leadloom.checks.sqltext import rnd, sid, values_table

# Demotion rules (from, to, days without activity, new score). Written here again, so that a wrong one shows.
_rules = values_table("f, t, d, s", [
    ("rfq_submitted", "rfq_draft", 7, 60), ("quote_ready", "rfq_submitted", 14, 75),
    ("hot_in_market", "known_account_interest", 3, 60), ("engaged_person", "known_person_interest", 21, 65),
    ("engaged_account", "known_account_interest", 30, 60), ("known_account_interest", "intent_only", 60, 50),
    ("known_person_interest", "intent_only", 60, 50), ("intent_only", "visit_only", 90, 35),
    ("trade_buyer_candidate", "intent_only", 45, 50), ("strategic_account_watch", "visit_only", 180, 30),
    ("reactivation_candidate", "intent_only", 30, 50), ("competitor_displacement", "known_account_interest", 30, 60),
    ("active_importer", "intent_only", 90, 50)])
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
_lead = "(SELECT *, substr(replace(replace(hs_code, '[', ''), ']', ''), 1, 2) AS ch, upper(buyer_country) AS co FROM {market_leads})"
_match = "(s.hs_chapters IS NULL OR list_contains(s.hs_chapters, k.ch)) AND (s.target_countries IS NULL OR list_contains(s.target_countries, k.co) OR list_contains(s.target_countries, '*'))"

SELLERS: dict[str, str] = {
    "seller_stats": """
        SELECT s.seller_id, coalesce(a.n, 0) AS total_assigned, coalesce(c.n, 0) AS total_converted, CASE WHEN a.n > 0 THEN coalesce(c.n, 0) / CAST(a.n AS DOUBLE) ELSE 0 END AS win_rate, coalesce(a.h, 48) AS avg_response_h
        FROM {sellers} AS s LEFT JOIN (SELECT seller_id, count(*) AS n, avg(response_hours) AS h FROM {assignments} GROUP BY seller_id) AS a ON a.seller_id = s.seller_id
        LEFT JOIN (SELECT seller_id, count(*) AS n FROM {conversions} GROUP BY seller_id) AS c ON c.seller_id = s.seller_id""",
    "rank_sellers": f"""
        WITH k AS (SELECT DISTINCT ch, co, coalesce(visibility, '') AS visibility FROM {_lead} AS l),
        x AS (SELECT k.ch AS hs_chapter, k.co AS country, k.visibility, s.seller_id, st.win_rate, st.avg_response_h AS h, st.total_assigned AS ta, s.max_leads_per_day AS m, s.leads_today AS t, s.hs_chapters, s.target_countries,
                CASE k.visibility WHEN 'instant_alert' THEN 4 WHEN 'push_notify' THEN 24 WHEN 'priority' THEN 48 ELSE 168 END AS sla
              FROM k JOIN {{sellers}} AS s ON {_match} JOIN {{seller_stats}} AS st ON st.seller_id = s.seller_id),
        y AS (SELECT *, {rnd("0.30 * CASE WHEN hs_chapters IS NULL THEN 0.5 ELSE 1.0 END + 0.15 * CASE WHEN target_countries IS NULL OR list_contains(target_countries, '*') THEN 0.5 ELSE 1.0 END + 0.20 * least(win_rate * 2.5, 1.0) + 0.15 * CASE WHEN h <= sla * 0.25 THEN 1.0 WHEN h <= sla * 0.5 THEN 0.75 WHEN h <= sla THEN 0.5 ELSE 0.1 END + 0.10 * least(greatest(0, m - t) / CAST(m AS DOUBLE), 1.0) + 0.10 * least(ta / 100.0, 1.0)", 4)} AS rank_score FROM x)
        SELECT hs_chapter, country, visibility, seller_id, rank_score, row_number() OVER (PARTITION BY hs_chapter, country, visibility ORDER BY rank_score DESC, seller_id) AS rank FROM y""",
    "credit_ledger": """
        WITH RECURSIVE t AS (SELECT seller_id, kind, amount, row_number() OVER (PARTITION BY seller_id ORDER BY "at", tx_id) AS n FROM {transactions}),
        s AS (SELECT seller_id, credits_available AS b, credits_used_month AS u, CAST(0 AS BIGINT) AS r, credits_total_month AS m, CAST(0 AS BIGINT) AS n FROM {accounts}
          UNION ALL SELECT s.seller_id, CASE WHEN t.kind = 'topup' THEN s.b + t.amount WHEN s.m <> -1 AND t.amount <= s.b THEN s.b - t.amount ELSE s.b END AS b,
                 CASE WHEN t.kind <> 'topup' AND (s.m = -1 OR t.amount <= s.b) THEN s.u + t.amount ELSE s.u END AS u, CASE WHEN t.kind <> 'topup' AND s.m <> -1 AND t.amount > s.b THEN s.r + 1 ELSE s.r END AS r, s.m, t.n
          FROM s JOIN t ON t.seller_id = s.seller_id AND t.n = s.n + 1)
        SELECT seller_id, arg_max(b, n) AS credits_available, arg_max(u, n) AS credits_used, arg_max(r, n) AS refused FROM s GROUP BY seller_id""",
    "pending_leads": """
        SELECT lead_id, lead_type, distribution_status FROM {distribution_leads} WHERE seller_visible AND coalesce(distribution_status, 'pending') = 'pending' AND coalesce(lead_type, '') <> 'blocked'
           AND lead_id NOT IN (SELECT lead_id FROM {assignments} WHERE status = 'converted')""",
    "mark_distributed": """
        SELECT lead_id, CASE WHEN h THEN 'distributed' ELSE distribution_status END AS distribution_status, CASE WHEN h THEN TIMESTAMP '2024-01-31 00:00:00' END AS distributed_at
        FROM (SELECT *, lead_id IN (SELECT lead_id FROM {assignments} WHERE status = 'assigned') AS h FROM {distribution_leads}) AS x""",
    "assign_leads": f"""
        WITH p AS (SELECT s.seller_id, k.lead_id, k.priority, k.ch, k.co, s.hs_chapters, s.target_countries, s.credits_available AS cr, greatest(0, s.max_leads_per_day - s.leads_today) AS cap,
                CASE k.priority WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 ELSE 4 END AS c, k.score FROM {_lead} AS k JOIN {{sellers}} AS s ON s.active AND {_match}),
        q AS (SELECT *, row_number() OVER (PARTITION BY seller_id, c ORDER BY score DESC, lead_id) AS rn FROM p),
        n AS (SELECT seller_id, any_value(cr) AS cr, any_value(cap) AS cap, count(*) FILTER (WHERE c = 1) AS n1, count(*) FILTER (WHERE c = 2) AS n2, count(*) FILTER (WHERE c = 3) AS n3 FROM p GROUP BY seller_id),
        a AS (SELECT *, least(n1, floor(cr / 5), cap) AS a1 FROM n), b AS (SELECT *, least(n2, floor((cr - 5 * a1) / 3), cap - a1) AS a2 FROM a),
        d AS (SELECT *, least(n3, floor(cr - 5 * a1 - 3 * a2), cap - a1 - a2) AS a3 FROM b)
        SELECT 'sla:' || q.seller_id || ':' || q.lead_id AS assignment_id, q.seller_id, q.lead_id, q.priority,
               coalesce(nullif(concat_ws(',', CASE WHEN q.hs_chapters IS NOT NULL THEN 'hs_' || q.ch END, CASE WHEN q.target_countries IS NOT NULL THEN 'geo_' || q.co END), ''), 'open_match') AS match_reason,
               CASE q.priority WHEN 'critical' THEN 5 WHEN 'high' THEN 3 WHEN 'medium' THEN 1 ELSE 0 END AS credits_cost
        FROM q JOIN d ON q.seller_id = d.seller_id WHERE q.rn <= CASE q.c WHEN 1 THEN d.a1 WHEN 2 THEN d.a2 WHEN 3 THEN d.a3 ELSE d.cap - d.a1 - d.a2 - d.a3 END""",
    "reset_daily_counts": "SELECT seller_id, CASE WHEN leads_today_date = DATE '2024-01-31' THEN leads_today ELSE 0 END AS leads_today, DATE '2024-01-31' AS leads_today_date FROM {sellers}",
    "upsert_sellers": """
        SELECT coalesce(g.seller_id, s.seller_id) AS seller_id, coalesce(g.name, s.name) AS name, coalesce(g.tier, s.tier, 'basic') AS tier, coalesce(g.max_leads_per_day, s.max_leads_per_day, 50) AS max_leads_per_day,
               coalesce(s.credits_available, 0) AS credits_available, coalesce(s.active, TRUE) AS active FROM {sellers} AS s FULL OUTER JOIN {given_sellers} AS g ON s.seller_id = g.seller_id""",
    "billing_reset": """
        SELECT seller_id, CASE WHEN billing_cycle_start <= DATE '2024-01-01' THEN 0 ELSE credits_used_month END AS credits_used_month,
               CASE WHEN billing_cycle_start <= DATE '2024-01-01' AND credits_total_month <> -1 THEN credits_total_month ELSE credits_available END AS credits_available,
               CASE WHEN billing_cycle_start <= DATE '2024-01-01' THEN DATE '2024-01-31' ELSE billing_cycle_start END AS billing_cycle_start FROM {accounts}""",
    "tier_access": """
        SELECT a.assignment_id, s.tier, l.priority, CASE s.tier WHEN 'enterprise' THEN TRUE WHEN 'professional' THEN l.priority <> 'critical' ELSE l.priority NOT IN ('critical', 'high') END AS accessible
        FROM {assignments} AS a JOIN {leads} AS l ON l.lead_uid = a.lead_id JOIN {sellers} AS s ON s.seller_id = a.seller_id""",
    "valid_acts": "SELECT * FROM {actions} WHERE action <> 'waved'",
    "record_feedback": """
        SELECT a.assignment_id, coalesce(x.action, a.status) AS status, coalesce(x.recorded_at, a.actioned_at) AS actioned_at, nullif(x.notes, '') AS action_notes FROM {assignments} AS a LEFT JOIN
        (SELECT * FROM {valid_acts} QUALIFY row_number() OVER (PARTITION BY assignment_id ORDER BY recorded_at DESC) = 1) AS x ON x.assignment_id = a.assignment_id""",
    "feedback_rows": """
        SELECT 'fb:' || x.assignment_id || ':' || x.action AS feedback_id, x.assignment_id, a.seller_id, a.lead_id, l.lead_type, l.priority AS lead_priority, x.action, x.notes, x.recorded_at
        FROM (SELECT * FROM {valid_acts} QUALIFY row_number() OVER (PARTITION BY assignment_id, action ORDER BY recorded_at DESC) = 1) AS x JOIN {assignments} AS a ON a.assignment_id = x.assignment_id JOIN {leads} AS l ON l.lead_uid = a.lead_id""",
    "lead_feedback": """
        SELECT l.lead_uid, x.action AS seller_feedback, x.recorded_at AS seller_actioned_at FROM {leads} AS l LEFT JOIN (SELECT a.lead_id, v.* FROM {valid_acts} AS v JOIN {assignments} AS a ON a.assignment_id = v.assignment_id
        QUALIFY row_number() OVER (PARTITION BY a.lead_id ORDER BY v.recorded_at DESC) = 1) AS x ON x.lead_id = l.lead_uid""",
    "feedback_rates": """
        SELECT lead_type, count(*) AS total, count(*) FILTER (WHERE action = 'converted') AS converted, count(*) FILTER (WHERE action = 'rejected') AS rejected, count(*) FILTER (WHERE action = 'viewed') AS viewed,
               count(*) FILTER (WHERE action = 'converted') / CAST(count(*) AS DOUBLE) AS conversion_rate, count(*) FILTER (WHERE action = 'rejected') / CAST(count(*) AS DOUBLE) AS rejection_rate
        FROM {feedback_log} WHERE recorded_at >= TIMESTAMP '2024-01-03 00:00:00' GROUP BY lead_type""",
    "tune_thresholds": """
        WITH r AS (SELECT lead_type, conversion_rate AS c, rejection_rate AS j FROM {feedback_rates} WHERE (SELECT sum(total) FROM {feedback_rates}) >= 50)
        SELECT 'min_score_rfq' AS setting, 75 AS old_value, CASE WHEN c > 0.4 THEN 73 ELSE 77 END AS new_value FROM r WHERE lead_type = 'rfq_submitted' AND (c > 0.4 OR c < 0.1)
        UNION ALL SELECT 'min_score_trade' AS setting, 40 AS old_value, 42 AS new_value FROM r WHERE lead_type = 'trade_buyer_candidate' AND j > 0.6
        UNION ALL SELECT 'min_score_decision_maker' AS setting, 55 AS old_value, 53 AS new_value FROM r WHERE lead_type = 'buying_committee_active' AND c > 0.3
        UNION ALL SELECT 'seller_visible_evidence_min' AS setting, 50 AS old_value, 55 AS new_value FROM r WHERE lead_type = 'warm_account' AND j > 0.7""",
    "conversion_facts": f"""
        SELECT {sid("a.assignment_id", "'conversion'")} AS conversion_id, a.assignment_id, a.seller_id, a.lead_id, l.lead_type, l.hs_code, l.buyer_user_id AS buyer_key, l.score_final AS final_score, 0.0::DOUBLE AS deal_value,
               greatest(0, CAST(floor((epoch(a.actioned_at) - epoch(a.assigned_at)) / 86400.0) AS BIGINT)) AS days_to_convert, a.actioned_at AS converted_at
        FROM {{assignments}} AS a JOIN {{leads}} AS l ON l.lead_uid = a.lead_id WHERE a.status = 'converted' AND a.assignment_id NOT IN (SELECT assignment_id FROM {{old_facts}})""",
    "converted_leads": "SELECT l.lead_uid, CASE WHEN c.lead_id IS NULL THEN 'new' ELSE 'converted' END AS status, c.converted_at FROM {leads} AS l LEFT JOIN {conversion_facts} AS c ON c.lead_id = l.lead_uid",
    "link_conversion_buyers": """
        SELECT DISTINCT c.conversion_id, o.org_id FROM {conversion_facts} AS c JOIN {orgs} AS o ON lower(trim(o.org_id)) = lower(trim('c' || c.buyer_key)) OR lower(trim(o.org_name)) = lower(trim('c' || c.buyer_key))""",
    "conversion_stats": "SELECT lead_type, count(*) AS conversions, avg(days_to_convert) AS avg_days, avg(final_score) AS avg_score FROM {conversion_facts} GROUP BY lead_type",
    "stale": f"""
        SELECT l.*, r.t, r.s, r.d FROM {{leads}} AS l JOIN (SELECT * FROM {_rules}) AS r ON r.f = l.lead_type
        WHERE NOT coalesce(l.suppressed, FALSE) AND coalesce(l.distribution_status, '') <> 'suppressed' AND (l.last_transition_at IS NULL OR l.last_transition_at < {NOW} - to_days(CAST(r.d AS INTEGER)))
          AND (l.classified_at IS NULL OR l.classified_at < {NOW} - to_days(CAST(r.d AS INTEGER)))""",
    "demote_stale": f"""
        SELECT l.lead_uid, coalesce(x.t, l.lead_type) AS lead_type, coalesce(x.s, l.score_final) AS score_final,
               CASE WHEN x.t IS NULL THEN l.visibility_level WHEN x.t = 'rfq_draft' THEN 'push_notify' WHEN x.t = 'rfq_submitted' THEN 'instant_alert' WHEN x.t = 'visit_only' THEN 'count_only' ELSE 'feed' END AS visibility_level,
               CASE WHEN x.t IS NOT NULL THEN l.lead_type END AS previous_lead_type, CASE WHEN x.t IS NOT NULL THEN {NOW} ELSE l.last_transition_at END AS last_transition_at,
               l.transition_count + CASE WHEN x.t IS NULL THEN 0 ELSE 1 END AS transition_count
        FROM {{leads}} AS l LEFT JOIN {{stale}} AS x ON x.lead_uid = l.lead_uid""",
    "state_history": f"""
        SELECT 'lsh:demotion:' || lead_uid || ':2024-01-31T00:00:00' AS history_uid, lead_uid, lead_type AS state_from, t AS state_to, 'staleness_' || d || 'd' AS reason, 'demotion' AS triggered_by,
               s AS score_at_transition, {NOW} AS transitioned_at FROM {{stale}}""",
    "apply_overrides": """
        SELECT l.lead_uid, l.lead_type, CASE WHEN x.lead_uid IS NULL THEN l.score_final WHEN x.new_score IS NOT NULL THEN x.new_score ELSE coalesce(l.score_final_original, l.score_final) END AS score_final,
               CASE WHEN x.new_score IS NOT NULL AND NOT coalesce(l.score_override, FALSE) THEN l.score_final ELSE l.score_final_original END AS score_final_original,
               CASE WHEN x.lead_uid IS NULL THEN l.score_override ELSE x.new_score IS NOT NULL END AS score_override, CASE WHEN x.new_score IS NOT NULL THEN x.reason END AS score_reason,
               CASE WHEN x.new_score IS NOT NULL THEN x.changed_by END AS score_changed_by, CASE WHEN x.new_score IS NOT NULL THEN x.changed_at END AS score_changed_at
        FROM {overridable} AS l LEFT JOIN (SELECT * FROM {overrides} QUALIFY row_number() OVER (PARTITION BY lead_uid ORDER BY changed_at DESC) = 1) AS x ON x.lead_uid = l.lead_uid""",
    "override_audit": """
        SELECT 'Lead' AS node_type, lead_uid AS node_id, lead_type AS sub_type, CAST(score_final_original AS DOUBLE) AS original_score, CAST(score_final AS DOUBLE) AS current_score, score_reason AS reason,
               score_changed_by AS changed_by, score_changed_at AS changed_at FROM {apply_overrides} WHERE score_override
        UNION ALL SELECT kind, key, sub, original, score, reason, changed_by, changed_at FROM {overridden_nodes} WHERE kind <> 'Lead' AND hand""",
}
