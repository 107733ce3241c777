"""DuckDB statements for trade, enrichment, health and switch operators, from their definitions."""

from leadloom.checks.sqltext import sid, words

# Fixed values, written here again so that a wrong one in an operator shows: words that mark titles and news.
DECISION_MAKER_WORDS = ["procurement", "supply chain", "purchasing", "cpo", "vp supply", "sourcing", "operations", "logistics"]
LEADERSHIP_WORDS = ["ceo", "cpo", "vp", "director", "chief", "president", "appoint", "resign", "hire", "named"]
FUNDING_WORDS = ["funding", "investment", "raise", "series", "capital", "venture", "ipo"]
MERGER_WORDS = ["merger", "acquisition", "acquire", "merge", "takeover", "buyout"]

ASOF = "TIMESTAMP '2001-11-05 00:00:00'"
DAY = "DATE '2001-11-05'"
REL = sid("buyer_id", "supplier_id", "hs_code")

TRADE: dict[str, str] = {
    "monthly_trade": f"""
        SELECT {REL} AS rel_id, buyer_id, supplier_id, hs_code, CAST(date_trunc('month', ship_date) AS DATE) AS year_month,
               min(nullif(buyer_name, '')) AS buyer_name, min(nullif(supplier_name, '')) AS supplier_name,
               count(*) AS shipment_count, sum(coalesce(quantity, 0)) AS total_quantity, sum(coalesce(value, 0)) AS total_value,
               CAST(max(ship_date) AS DATE) AS last_shipment_date
        FROM {{shipments}} WHERE ship_date >= {ASOF} - INTERVAL 36 MONTH
        GROUP BY buyer_id, supplier_id, hs_code, CAST(date_trunc('month', ship_date) AS DATE)""",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY rel_id ORDER BY year_month) AS rn,
               row_number() OVER (PARTITION BY rel_id ORDER BY year_month DESC) AS rd,
               count(*) OVER (PARTITION BY rel_id) AS n FROM {monthly_trade}""",
    "trade_baseline": """
        SELECT rel_id, avg(total_quantity) AS baseline_avg_qty, avg(total_value) AS baseline_avg_value,
               count(*) AS baseline_months FROM {numbered} WHERE rn <= 6 GROUP BY rel_id""",
    "trade_relationships": """
        SELECT m.rel_id, m.buyer_id, m.supplier_id, m.hs_code,
               coalesce(arg_min(m.buyer_name, m.year_month), '') AS buyer_name,
               coalesce(arg_min(m.supplier_name, m.year_month), '') AS supplier_name,
               CAST(sum(m.shipment_count) AS BIGINT) AS total_shipments, count(*) AS relationship_age_months,
               max(b.baseline_avg_qty) AS baseline_avg_qty, max(b.baseline_avg_value) AS baseline_avg_value,
               max(m.last_shipment_date) AS last_shipment_date, max(m.year_month) AS last_month,
               substr(m.hs_code, 1, 2) AS hs_chapter, 'shipment_bl' AS data_source
        FROM {monthly_trade} AS m JOIN {trade_baseline} AS b ON m.rel_id = b.rel_id
        GROUP BY m.rel_id, m.buyer_id, m.supplier_id, m.hs_code""",
    "trade_snapshots": f"""
        SELECT {sid("m.rel_id", "strftime(m.year_month, '%Y-%m-%d')")} AS snapshot_id, m.rel_id, m.year_month, m.shipment_count,
               m.total_quantity, m.total_value,
               CASE WHEN b.baseline_avg_qty > 0 THEN CAST(round(CAST((m.total_quantity / b.baseline_avg_qty - 1.0) * 100 AS DECIMAL(38, 9)), 2) AS DOUBLE)
                    ELSE 0.0 END AS qty_vs_baseline_pct
        FROM {{monthly_trade}} AS m JOIN {{trade_baseline}} AS b ON m.rel_id = b.rel_id""",
    "relationships_from_partners": f"""
        SELECT {REL} AS rel_id, * FROM (
          SELECT p.company_id AS buyer_id, p.company_name AS buyer_name, p.partner_company_id AS supplier_id,
                 p.partner_company_name AS supplier_name, h.hs_code, substr(h.hs_code, 1, 2) AS hs_chapter,
                 b.number_of_shipments AS total_shipments,
                 greatest(1, CAST(floor(datediff('day', b.from_date, b.to_date) / 30.0) AS BIGINT)) AS relationship_age_months,
                 CAST(round(CAST(p.trade_volume_kg * h.import_share_pct / 100 / 12 AS DECIMAL(38, 9)), 2) AS DOUBLE) AS baseline_avg_qty, 0.0::DOUBLE AS baseline_avg_value,
                 b.to_date AS last_shipment_date, 'import_partner' AS data_source, b.from_date, b.to_date
          FROM {{import_partner}} AS p JOIN {{imported_hs}} AS h ON p.company_id = h.company_id
          LEFT JOIN {{company_list}} AS b ON p.company_id = b.company_id AND lower(b.company_role) = 'buyer'
          WHERE h.import_share_pct >= 0.5) AS x""",
    "synthetic_months": f"""
        SELECT {sid("rel_id", "strftime(ym, '%Y-%m-%d')")} AS snapshot_id, rel_id, ym AS year_month,
               CASE WHEN q > 0 THEN greatest(1, CAST(floor(q / 1000) AS BIGINT)) ELSE 0 END AS shipment_count,
               q AS total_quantity, 0.0::DOUBLE AS total_value, 0.0::DOUBLE AS qty_vs_baseline_pct
        FROM (SELECT rel_id, ym, CAST(round(CAST(baseline_avg_qty * CASE WHEN lf < 6 THEN greatest(0.1, 1.0 - (lf / total) * 0.3) ELSE 1.0 END AS DECIMAL(38, 9)), 2) AS DOUBLE) AS q
          FROM (SELECT rel_id, baseline_avg_qty, CAST(ym AS DATE) AS ym,
                       CAST(floor(datediff('day', CAST(ym AS DATE), to_date) / 30.0) AS DOUBLE) AS lf, total
            FROM (SELECT *, floor(datediff('day', from_date, to_date) / 30.0) AS total,
                    unnest(generate_series(date_trunc('month', from_date), date_trunc('month', to_date), INTERVAL 1 MONTH)) AS ym
                  FROM {{relationships_from_partners}}) AS a WHERE total > 0) AS b) AS c""",
    "relationships_from_codes": f"""
        SELECT {REL} AS rel_id, * FROM (
          SELECT b.company_id AS buyer_id, b.company_name AS buyer_name, s.company_id AS supplier_id, s.company_name AS supplier_name,
                 i.hs_code, substr(i.hs_code, 1, 2) AS hs_chapter, b.number_of_shipments AS total_shipments,
                 greatest(1, CAST(floor(datediff('day', b.from_date, b.to_date) / 30.0) AS BIGINT)) AS relationship_age_months,
                 CAST(round(CAST(b.shipment_value * i.import_share_pct / 100 / 12 AS DECIMAL(38, 9)), 2) AS DOUBLE) AS baseline_avg_qty, 0.0::DOUBLE AS baseline_avg_value,
                 b.to_date AS last_shipment_date, 'bsl_crossmatch' AS data_source
          FROM {{company_list}} AS b JOIN {{imported_hs}} AS i ON b.company_id = i.company_id
          JOIN {{exported_hs}} AS e ON i.hs_code = e.hs_code JOIN {{company_list}} AS s ON e.company_id = s.company_id
          WHERE b.company_role = 'buyer' AND lower(s.company_role) = 'supplier' AND b.company_id <> s.company_id
            AND i.import_share_pct >= 1.0 AND e.export_share_pct >= 1.0) AS x""",
    "union_trade_sources": """
        SELECT * EXCLUDE (place) FROM (
          SELECT rel_id, buyer_id, buyer_name, supplier_id, supplier_name, hs_code, hs_chapter, total_shipments,
                 relationship_age_months, baseline_avg_qty, baseline_avg_value, last_shipment_date, data_source, place
          FROM (SELECT *, 1 AS place FROM {trade_relationships} UNION ALL BY NAME
                SELECT *, 2 AS place FROM {relationships_from_partners} UNION ALL BY NAME
                SELECT *, 3 AS place FROM {relationships_from_codes}) AS u
          QUALIFY row_number() OVER (PARTITION BY rel_id ORDER BY place) = 1) AS k""",
    "apply_external_health": """
        SELECT r.rel_id, r.buyer_id, r.supplier_id, h.anomaly_score, x.trade_relationship_health AS external_health_score,
               CASE WHEN h.health_score IS NULL THEN x.trade_relationship_health
                    WHEN x.trade_relationship_health < h.health_score AND r.total_shipments % 5 <> 0
                    THEN x.trade_relationship_health ELSE h.health_score END AS health_score
        FROM {trade_relationships} AS r
        LEFT JOIN (SELECT * FROM {health_status} WHERE anomaly_score > 0) AS h ON r.rel_id = h.rel_id
        LEFT JOIN {external_health} AS x ON r.supplier_id = x.supplier_id AND r.buyer_id = x.buyer_id""",
    # --- outside reports ------------------------------------------------------------------------
    "match_profiles": """
        WITH latest AS (SELECT * FROM {profiles} QUALIFY row_number() OVER (PARTITION BY company_id
            ORDER BY modified_on DESC, company_name DESC, trade_health_score DESC, supplier_risk_score DESC, total_shipment_count DESC) = 1),
        hits AS (SELECT l.*, o.org_id, CASE WHEN o.org_id = l.company_id THEN 1 WHEN o.profile_tag = l.company_id THEN 2 ELSE 3 END AS how
            FROM latest AS l JOIN {orgs} AS o ON o.org_id = l.company_id OR o.profile_tag = l.company_id
                OR (lower(o.org_name) = lower(l.company_name))),
        best AS (SELECT company_id, min(how) AS how FROM hits GROUP BY company_id)
        SELECT h.org_id, h.company_id, CASE h.how WHEN 1 THEN 'id' WHEN 2 THEN 'tag' ELSE 'name' END AS matched_by,
               h.trade_health_score, h.supplier_risk_score, h.total_shipment_count, h.company_type
        FROM hits AS h JOIN best AS b ON h.company_id = b.company_id AND h.how = b.how""",
    "enrich_orgs_by_name": """
        SELECT o.org_id, c.company_name AS matched_company, c.employee_count, c.industry, c.domain AS company_domain, c.country AS company_country
        FROM {orgs} AS o JOIN {company_search} AS c
          ON contains(lower(o.org_name), lower(c.company_name)) OR (c.domain <> '' AND o.domain = c.domain)
        QUALIFY row_number() OVER (PARTITION BY o.org_id ORDER BY length(c.company_name) DESC, c.company_name DESC,
            c.employee_count DESC, c.industry DESC, c.domain DESC, c.country DESC) = 1""",
    "contacts": f"""
        WITH named AS (SELECT coalesce(nullif(trim(coalesce(full_name, '')), ''),
                 nullif(trim(concat(trim(coalesce(first_name, '')), ' ', trim(coalesce(last_name, '')))), ''), 'Unknown') AS name,
                 coalesce(title, '') AS title, coalesce(email, '') AS email, coalesce(phone, '') AS phone,
                 coalesce(company_name, '') AS company_name, coalesce(seniority_level, '') AS seniority_level FROM {{contact_rows}})
        SELECT *, CASE WHEN email <> '' THEN email ELSE 'zi:' || name END AS person_key,
               {words('title', DECISION_MAKER_WORDS)} AS is_decision_maker
        FROM named QUALIFY row_number() OVER (PARTITION BY CASE WHEN email <> '' THEN email ELSE 'zi:' || name END
            ORDER BY {words('title', DECISION_MAKER_WORDS)} DESC, title DESC, name DESC, email DESC, phone DESC, company_name DESC) = 1""",
    "contact_links": """
        SELECT DISTINCT p.person_key, o.org_id FROM {contacts} AS p JOIN {orgs} AS o
          ON p.company_name <> '' AND contains(lower(o.org_name), lower(p.company_name))""",
    "intent_per_company": """
        SELECT company_name, count(*) AS intent_signal_count, string_agg(DISTINCT topic, ', ' ORDER BY topic) AS intent_topics,
               max(signal_date) AS last_intent_date FROM {intent_rows} GROUP BY company_name""",
    "news_flags": f"""
        SELECT company_name, count(*) AS news_count, max(news_date) AS last_news_date,
               bool_or({words('content', LEADERSHIP_WORDS)}) AS has_leadership_change,
               bool_or({words('content', FUNDING_WORDS)}) AS has_funding_event,
               bool_or({words('content', MERGER_WORDS)}) AS has_ma_event
        FROM (SELECT * FROM {{news_rows}} UNION ALL SELECT * FROM {{scoop_rows}}) AS u GROUP BY company_name""",
    "org_intent": """
        SELECT o.org_id, i.company_name, i.intent_signal_count, i.intent_topics, i.last_intent_date
        FROM {orgs} AS o JOIN {intent_per_company} AS i ON contains(lower(o.org_name), lower(i.company_name))""",
    "org_news": """
        SELECT o.org_id, f.* FROM {orgs} AS o JOIN {news_flags} AS f ON contains(lower(o.org_name), lower(f.company_name))""",
    # --- health ----------------------------------------------------------------------------------
    "stress_rules": f"""
        WITH s AS (SELECT rel_id, avg(total_quantity) FILTER (WHERE rd <= 2) AS rq, avg(shipment_count) FILTER (WHERE rd <= 2) AS rf,
                          avg(shipment_count) AS mf FROM {{numbered}} GROUP BY rel_id),
        j AS (SELECT r.*, s.rq, s.rf, s.mf, coalesce(datediff('day', r.last_shipment_date, {DAY}), 9999) AS days,
                CASE WHEN r.baseline_avg_qty > 0 AND s.rq IS NOT NULL
                     THEN greatest(0.0, (r.baseline_avg_qty - s.rq) / r.baseline_avg_qty) ELSE 0.0 END AS dr
              FROM {{trade_relationships}} AS r LEFT JOIN s ON r.rel_id = s.rel_id),
        k AS (SELECT *, CASE WHEN mf IS NOT NULL AND days > 180 THEN 'churned'
                WHEN days > 90 OR (mf IS NOT NULL AND dr >= 0.7) THEN 'dormant'
                WHEN dr >= 0.3 OR days BETWEEN 45 AND 90 THEN 'stressed'
                WHEN mf > 0 AND rf < mf * 0.5 THEN 'irregular' ELSE 'healthy' END AS rule_status FROM j)
        SELECT rel_id, buyer_id, buyer_name, supplier_id, supplier_name, hs_code, baseline_avg_qty, rule_status,
               CAST(CASE rule_status WHEN 'churned' THEN 95 WHEN 'dormant' THEN 80 WHEN 'stressed' THEN 60 WHEN 'irregular' THEN 35 ELSE 10 END AS DOUBLE) AS rule_score,
               CASE rule_status WHEN 'churned' THEN 'no_shipment_6_months'
                 WHEN 'dormant' THEN CASE WHEN days > 90 THEN 'no_shipment_3_months' ELSE 'volume_collapsed_70pct' END
                 WHEN 'stressed' THEN CASE WHEN dr >= 0.3 THEN 'volume_drop_' || CAST(CAST(floor(dr * 100) AS INTEGER) AS VARCHAR) || 'pct' ELSE 'shipment_gap_45_90d' END
                 WHEN 'irregular' THEN 'shipment_frequency_halved' ELSE 'no_stress_signals' END AS rule_reason,
               CASE WHEN days < 9999 THEN days END AS rule_days_silent, CAST(round(CAST(dr * 100 AS DECIMAL(38, 9)), 1) AS DOUBLE) AS rule_vol_drop_pct FROM k""",
    "series_features": """
        SELECT rel_id, avg(total_quantity) AS mean_qty,
               CASE WHEN avg(total_quantity) > 0 THEN coalesce(stddev_samp(total_quantity), 0) / avg(total_quantity) ELSE 0 END AS cv_qty,
               CASE WHEN count(*) >= 3 THEN round(regr_slope(total_quantity, CAST(rn AS DOUBLE)), 9) ELSE 0 END AS slope,
               avg(CASE WHEN total_quantity = 0 THEN 1.0 ELSE 0.0 END) AS zero_frac,
               CASE WHEN avg(total_quantity) FILTER (WHERE rn <= 6) > 0
                    THEN avg(total_quantity) FILTER (WHERE rd <= 3) / avg(total_quantity) FILTER (WHERE rn <= 6) ELSE 1 END AS recent_vs_baseline,
               count(*) AS n_months FROM {numbered} GROUP BY rel_id""",
    "anomaly_statistical": """
        SELECT *, greatest(0.0, least(1.0, (1 - recent_vs_baseline) * 0.5 + cv_qty * 0.3 + zero_frac * 0.2)) AS anomaly_score
        FROM {series_features}""",
    "health_status": """
        SELECT rel_id, CAST(round(CAST(anomaly_score AS DECIMAL(38, 9)), 4) AS DOUBLE) AS anomaly_score,
               CASE WHEN recent_vs_baseline < 0.2 THEN 'collapsed' WHEN slope < -0.1 THEN 'declining' WHEN slope > 0.1 THEN 'growing' ELSE 'stable' END AS trend_direction,
               CAST(round(CAST(h AS DECIMAL(38, 9)), 1) AS DOUBLE) AS health_score,
               CASE WHEN h >= 70 THEN 'healthy' WHEN h >= 40 THEN 'stressed' WHEN h >= 20 THEN 'dormant' ELSE 'churned' END AS health_status
        FROM (SELECT *, greatest(0.0, least(100.0, 100 - anomaly_score * 60 - CASE WHEN anomaly_score > 0.7 THEN 20 ELSE 0 END)) AS h
              FROM {anomaly_statistical}) AS x""",
    "stress_reason": f"""
        SELECT h.*, CASE WHEN health_status = 'churned' THEN 'churned'
                 WHEN datediff('day', r.last_shipment_date, {DAY}) > 180 THEN 'long_gap'
                 WHEN trend_direction = 'declining' THEN 'quantity_drop' WHEN trend_direction = 'collapsed' THEN 'long_gap' ELSE 'irregular' END AS stress_reason
        FROM {{health_status}} AS h LEFT JOIN {{trade_relationships}} AS r ON h.rel_id = r.rel_id""",
    # --- switch ----------------------------------------------------------------------------------
    "opps_rules": f"""
        SELECT {sid("buyer_id", "supplier_id", "hs_code", "'rule_opp'")} AS opportunity_id, rel_id, buyer_id, buyer_name,
               supplier_id AS existing_supplier_id, supplier_name AS existing_supplier_name, hs_code, rule_reason AS stress_reason,
               rule_score AS stress_score, baseline_avg_qty AS buyer_monthly_volume, 'rule_based' AS detection_method, 'open' AS status,
               {ASOF} AS first_detected_at
        FROM {{stress_rules}} WHERE rule_status IN ('stressed', 'dormant', 'churned')""",
    "opps_model": f"""
        SELECT {sid("r.buyer_id", "r.supplier_id", "r.hs_code", "'opp'")} AS opportunity_id, h.rel_id, r.buyer_id, r.buyer_name,
               r.supplier_id AS existing_supplier_id, r.supplier_name AS existing_supplier_name, r.hs_code, h.stress_reason,
               CAST(round(CAST(100 - h.health_score AS DECIMAL(38, 9)), 1) AS DOUBLE) AS stress_score, r.baseline_avg_qty AS buyer_monthly_volume,
               'ml_based' AS detection_method, 'open' AS status, {ASOF} AS first_detected_at
        FROM {{stress_reason}} AS h JOIN {{trade_relationships}} AS r ON h.rel_id = r.rel_id
        WHERE h.health_status IN ('stressed', 'dormant', 'churned')""",
    "switch_opportunities": "SELECT * FROM {opps_rules} UNION ALL SELECT * FROM {opps_model}",
    "supplier_act": f"""
        SELECT r.supplier_id, count(DISTINCT r.buyer_id) AS active_buyers, sum(m.total_quantity) AS recent_vol, max(m.year_month) AS last_export
        FROM {{trade_relationships}} AS r JOIN {{monthly_trade}} AS m ON r.rel_id = m.rel_id
        WHERE m.year_month >= {DAY} - INTERVAL 90 DAY GROUP BY r.supplier_id""",
    "relationship_features": f"""
        WITH m6 AS (SELECT rel_id, avg(total_quantity) AS a6, stddev_samp(total_quantity) AS sd, count(*) AS n6,
                avg(total_quantity) FILTER (WHERE year_month >= {DAY} - INTERVAL 3 MONTH) AS a3,
                count(*) FILTER (WHERE total_quantity = 0) AS z6
            FROM {{monthly_trade}} WHERE year_month >= {DAY} - INTERVAL 6 MONTH GROUP BY rel_id),
        bs AS (SELECT buyer_id, hs_code, count(DISTINCT supplier_id) AS n FROM {{trade_relationships}} GROUP BY buyer_id, hs_code),
        hs AS (SELECT hs_code, count(DISTINCT supplier_id) AS n FROM {{trade_relationships}} GROUP BY hs_code)
        SELECT r.rel_id, r.buyer_id, r.supplier_id, r.hs_code, r.relationship_age_months, r.total_shipments, r.baseline_avg_qty,
               datediff('day', r.last_shipment_date, {DAY}) AS last_shipment_date_days_ago,
               CAST(round(CAST(CASE WHEN r.baseline_avg_qty > 0 THEN coalesce(m6.a3, 0) / r.baseline_avg_qty ELSE 0 END AS DECIMAL(38, 9)), 4) AS DOUBLE) AS qty_trend_3m,
               CAST(round(CAST(CASE WHEN r.baseline_avg_qty > 0 THEN coalesce(m6.a6, 0) / r.baseline_avg_qty ELSE 0 END AS DECIMAL(38, 9)), 4) AS DOUBLE) AS qty_trend_6m,
               CAST(round(CAST(CASE WHEN m6.n6 >= 2 AND m6.a6 > 0 THEN m6.sd / m6.a6 ELSE 0 END AS DECIMAL(38, 9)), 4) AS DOUBLE) AS shipment_regularity,
               greatest(0, 6 - coalesce(m6.n6, 0)) + coalesce(m6.z6, 0) AS months_with_zero_shipments,
               bs.n AS buyer_total_supplier_count, coalesce(f.employee_count, 0) AS buyer_employee_count,
               CAST('0x' || substr(md5(lower(coalesce(f.industry, ''))), 1, 7) AS BIGINT) % 100 AS buyer_industry_encoded,
               coalesce(f.intent_count, 0) AS buyer_intent_signal_count,
               CAST(coalesce(f.leadership_change, 0) AS BIGINT) AS buyer_has_leadership_change,
               CAST(coalesce(f.funding_event, 0) AS BIGINT) AS buyer_has_funding_event, CAST(coalesce(f.ma_event, 0) AS BIGINT) AS buyer_has_ma_event,
               coalesce(a.active_buyers, 0) AS supplier_active_buyer_count, coalesce(a.recent_vol, 0) AS supplier_recent_export_volume,
               hs.n AS hs_code_market_supplier_count, coalesce(x.anomaly_score, 0) AS anomaly_score
        FROM {{trade_relationships}} AS r LEFT JOIN m6 ON r.rel_id = m6.rel_id
        JOIN bs ON r.buyer_id = bs.buyer_id AND r.hs_code = bs.hs_code JOIN hs ON r.hs_code = hs.hs_code
        LEFT JOIN {{firms}} AS f ON r.buyer_id = f.org_id LEFT JOIN {{supplier_act}} AS a ON r.supplier_id = a.supplier_id
        LEFT JOIN {{health_status}} AS x ON r.rel_id = x.rel_id""",
    "score_opportunities": """
        SELECT * EXCLUDE (status, p), CASE WHEN p >= 0.40 THEN CAST(round(CAST(p AS DECIMAL(38, 9)), 4) AS DOUBLE) END AS switch_probability,
               CASE WHEN p >= 0.40 THEN status ELSE 'filtered_low_probability' END AS status
        FROM (SELECT *, least(0.95, stress_score / 100 * 0.8) AS p FROM {switch_opportunities}) AS x""",
    "supplier_profile": f"""
        SELECT r.supplier_id, min(r.supplier_name) AS supplier_name, count(DISTINCT r.buyer_id) AS active_buyer_count,
               coalesce(sum(m.q), 0) AS recent_export_volume, coalesce(max(f.employee_count), 0) AS employee_count,
               max(CASE WHEN l.org_id IS NULL THEN 0 ELSE 1 END) AS has_contact,
               coalesce(datediff('day', max(m.last), {DAY}), 9999) AS export_recency_days
        FROM {{trade_relationships}} AS r
        LEFT JOIN (SELECT rel_id, sum(total_quantity) AS q, max(year_month) AS last FROM {{monthly_trade}}
                   WHERE year_month >= {DAY} - INTERVAL 90 DAY GROUP BY rel_id) AS m ON r.rel_id = m.rel_id
        LEFT JOIN {{firms}} AS f ON f.org_id = r.supplier_id
        LEFT JOIN (SELECT DISTINCT org_id FROM {{people_links}}) AS l ON l.org_id = r.supplier_id
        GROUP BY r.supplier_id""",
    "candidate_suppliers": """
        SELECT DISTINCT r.hs_code, p.supplier_id, p.supplier_name, p.active_buyer_count, p.recent_export_volume, p.employee_count,
               CAST(p.has_contact AS BIGINT) AS has_contact, p.export_recency_days, substr(r.hs_code, 1, 4) AS hs_prefix,
               CAST(round(CAST(3.0 * least(p.active_buyer_count, 10) + 10.0 * p.has_contact + 2.0 * greatest(0.0, 7 - p.export_recency_days / 30.0) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS own_points
        FROM {trade_relationships} AS r JOIN {supplier_profile} AS p ON r.supplier_id = p.supplier_id""",
    "rank_heuristic": """
        SELECT hs_code, supplier_id, 40.0 * (active_buyer_count % 2) + 20.0 + 15.0 * has_contact + 3.0 * least(active_buyer_count, 10) + 10.0 * has_contact
               + 2.0 * greatest(0.0, 7 - export_recency_days / 30.0) AS raw_score FROM {candidate_suppliers}""",
    "all_pairs": """
        SELECT o.opportunity_id, o.existing_supplier_id, p.supplier_id, any_value(p.supplier_name) AS supplier_name,
               any_value(p.active_buyer_count) AS active_buyer_count, any_value(p.has_contact) AS has_contact,
               any_value(p.own_points) AS own_points, max(CASE WHEN p.hs_code = o.hs_code THEN 1 ELSE 0 END) AS is_exact,
               any_value(CASE WHEN bc.country IS NOT NULL AND EXISTS (SELECT 1 AS one FROM {trade_relationships} AS t JOIN {buyer_countries} AS b2
                   ON t.buyer_id = b2.buyer_id WHERE t.supplier_id = p.supplier_id AND contains(b2.country, bc.country)) THEN 1 ELSE 0 END) AS there
        FROM (SELECT * FROM {score_opportunities} WHERE status = 'open' AND switch_probability >= 0.4) AS o
        JOIN {candidate_suppliers} AS p ON p.hs_prefix = substr(o.hs_code, 1, 4) AND p.supplier_id <> o.existing_supplier_id
        LEFT JOIN {buyer_countries} AS bc ON bc.buyer_id = o.buyer_id
        GROUP BY o.opportunity_id, o.existing_supplier_id, p.supplier_id""",
    "scored_pairs": """
        SELECT *, 40.0 * is_exact + 20.0 + 15.0 * there + own_points AS raw FROM {all_pairs}""",
    "match_suppliers": f"""
        SELECT {sid("opportunity_id", "supplier_id")} AS match_id, opportunity_id, supplier_id AS candidate_supplier_id,
               supplier_name AS candidate_supplier_name, CASE WHEN is_exact = 1 THEN 'exact' ELSE 'chapter' END AS hs_code_match_type,
               CAST(round(CAST(s AS DECIMAL(38, 9)), 1) AS DOUBLE) AS match_score, rk AS rank, active_buyer_count, there = 1 AS exports_to_buyer_country, has_contact > 0 AS has_contact
        FROM (SELECT *, CASE WHEN max(raw) OVER w - min(raw) OVER w < 1e-9 THEN 50.0
                     ELSE (raw - min(raw) OVER w) / (max(raw) OVER w - min(raw) OVER w) * 100 END AS s,
                     row_number() OVER (PARTITION BY opportunity_id ORDER BY raw DESC, supplier_id) AS rk
              FROM {{scored_pairs}} WINDOW w AS (PARTITION BY opportunity_id)) AS x
        WHERE rk <= 5 AND (rk = 1 OR s >= 60)""",
    "buyer_contacts": """
        SELECT l.org_id AS buyer_id, p.name AS contact_name, p.title AS contact_title, p.email AS contact_email
        FROM {people} AS p JOIN {people_links} AS l ON p.person_key = l.person_key WHERE p.is_decision_maker
        QUALIFY row_number() OVER (PARTITION BY l.org_id ORDER BY p.person_key) = 1""",
    "switch_leads_matched": f"""
        SELECT {sid("match_id", "'switch_lead'")} AS lead_id, opportunity_id, match_id, buyer_id, buyer_name, candidate_supplier_id,
               candidate_supplier_name, hs_code, stress_reason, switch_probability, match_score, f AS final_lead_score,
               CASE WHEN f >= 80 THEN 'critical' WHEN f >= 65 THEN 'high' WHEN f >= 50 THEN 'medium' ELSE 'low' END AS lead_priority,
               buyer_monthly_volume,
               'Buyer: ' || buyer_name || ' imports ' || hs_code || ' (~' || format('{{:,}}', CAST(floor(buyer_monthly_volume) AS BIGINT)) || ' units/month) from '
                 || existing_supplier_name || '. Relationship showing ' || replace(stress_reason, '_', ' ') || '. Switch probability: '
                 || CAST(CAST(CAST(round(CAST(switch_probability * 100 AS DECIMAL(38, 9)), 0) AS DOUBLE) AS INTEGER) AS VARCHAR) || '%. Contact: '
                 || CASE WHEN contact_name IS NULL THEN 'find via contact search' ELSE contact_name || ' (' || contact_title || ')' END || '.'
                 || CASE WHEN exports_to_buyer_country THEN ' Already ships to buyer country.' ELSE '' END
                 || CASE WHEN active_buyer_count > 0 THEN ' ' || CAST(active_buyer_count AS VARCHAR) || ' active buyers.' ELSE '' END AS recommended_action,
               coalesce(contact_name, '') AS contact_name, coalesce(contact_title, '') AS contact_title, coalesce(contact_email, '') AS contact_email,
               'new' AS status
        FROM (SELECT m.*, o.* EXCLUDE (opportunity_id, status), c.contact_name, c.contact_title, c.contact_email,
                CAST(round(CAST(least(100.0, o.switch_probability * 40 + m.match_score * 0.35 + least(o.buyer_monthly_volume / 10000, 25.0)) AS DECIMAL(38, 9)), 1) AS DOUBLE) AS f
              FROM {{match_suppliers}} AS m JOIN {{score_opportunities}} AS o ON m.opportunity_id = o.opportunity_id
              LEFT JOIN {{buyer_contacts}} AS c ON o.buyer_id = c.buyer_id
              WHERE m.match_score >= 60 AND o.status = 'open' AND o.switch_probability >= 0.4) AS x""",
    "rule_matches": """
        SELECT m.* FROM {match_suppliers} AS m JOIN {opps_rules} AS r ON m.opportunity_id = r.opportunity_id""",
    "switch_leads_unmatched": f"""
        SELECT {sid("opportunity_id", "'unmatched_lead'")} AS lead_id, opportunity_id, '' AS match_id, buyer_id, buyer_name, '' AS candidate_supplier_id,
               '[Sourcing Needed]' AS candidate_supplier_name, hs_code, stress_reason, switch_probability, 0.0::DOUBLE AS match_score, f AS final_lead_score,
               CASE WHEN f >= 80 OR health_score <= 10 THEN 'critical' ELSE 'high' END AS lead_priority, buyer_monthly_volume,
               'URGENT - Relationship ' || upper(health_status) || ': ' || buyer_name || ' imports ' || hs_code || ' (~'
                 || format('{{:,}}', CAST(floor(buyer_monthly_volume) AS BIGINT)) || ' units/month) from ' || existing_supplier_name
                 || '. Relationship showing ' || replace(stress_reason, '_', ' ') || ' (health score: '
                 || CAST(CAST(CAST(round(CAST(health_score AS DECIMAL(38, 9)), 0) AS DOUBLE) AS INTEGER) AS VARCHAR)
                 || '/100). No alternative supplier matched yet; look for one in the market. Switch probability: '
                 || CAST(CAST(CAST(round(CAST(switch_probability * 100 AS DECIMAL(38, 9)), 0) AS DOUBLE) AS INTEGER) AS VARCHAR) || '%.' AS recommended_action,
               coalesce(contact_name, '') AS contact_name, coalesce(contact_title, '') AS contact_title, coalesce(contact_email, '') AS contact_email,
               'sourcing_needed' AS status
        FROM (SELECT o.*, h.health_status, h.health_score, c.contact_name, c.contact_title, c.contact_email,
                CAST(round(CAST(least(100.0, o.switch_probability * 40 + least(o.buyer_monthly_volume / 10000, 25.0) + greatest(0.0, (100 - h.health_score) * 0.35)) AS DECIMAL(38, 9)), 1) AS DOUBLE) AS f
              FROM {{score_opportunities}} AS o JOIN {{health_status}} AS h ON o.rel_id = h.rel_id
              LEFT JOIN {{buyer_contacts}} AS c ON o.buyer_id = c.buyer_id
              WHERE o.status = 'open' AND o.switch_probability >= 0.4 AND h.health_status IN ('dormant', 'churned')
                AND NOT EXISTS (SELECT 1 AS one FROM {{rule_matches}} AS m WHERE m.opportunity_id = o.opportunity_id)) AS x""",
}
