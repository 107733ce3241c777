"""Operator inputs built from the given tables, in SQL that Spark and DuckDB both read.

They stand in for the source systems: who shipped what to whom comes from lineitem, user
activity from events, news and messages from documents and conversations. No operator logic
is in here.
"""

AS_OF_TRADE = "2001-11-05 00:00:00"
AS_OF_EVENTS = "2024-01-31 00:00:00"

FIXTURES: dict[str, str] = {
    # --- trade ------------------------------------------------------------------------------
    "shipments": """
        SELECT 'B' || CAST(c.c_nationkey AS STRING) AS buyer_id, 'Buyer ' || nb.n_name AS buyer_name,
               'S' || CAST(s.s_nationkey AS STRING) AS supplier_id, 'Supplier ' || ns.n_name AS supplier_name,
               p.p_type || CAST(p.p_size % 2 AS STRING) AS hs_code, l.l_quantity AS quantity,
               l.l_extendedprice * (1 - l.l_discount) AS value, l.l_shipdate AS ship_date
        FROM {lineitem} AS l JOIN {orders} AS o ON l.l_orderkey = o.o_orderkey
        JOIN {customer} AS c ON o.o_custkey = c.c_custkey JOIN {supplier} AS s ON l.l_suppkey = s.s_suppkey
        JOIN {part} AS p ON l.l_partkey = p.p_partkey JOIN {nation} AS nb ON c.c_nationkey = nb.n_nationkey
        JOIN {nation} AS ns ON s.s_nationkey = ns.n_nationkey""",
    "bills": """
        SELECT o.o_custkey AS consignee_id, c.c_name AS consignee_name, l.l_suppkey AS shipper_id,
               p.p_type AS HSCode, l.l_quantity AS net_weight, l.l_extendedprice AS fob_value,
               l.l_shipdate AS bl_date, l.l_tax AS other
        FROM {lineitem} AS l JOIN {orders} AS o ON l.l_orderkey = o.o_orderkey
        JOIN {customer} AS c ON o.o_custkey = c.c_custkey JOIN {part} AS p ON l.l_partkey = p.p_partkey""",
    "pair_totals": """
        SELECT buyer_id, supplier_id, min(buyer_name) AS buyer_name, min(supplier_name) AS supplier_name,
               sum(quantity) AS kg, count(*) AS n
        FROM {shipments} GROUP BY buyer_id, supplier_id""",
    "import_partner": """
        SELECT p.buyer_id AS company_id, p.buyer_name AS company_name, p.supplier_id AS partner_company_id,
               p.supplier_name AS partner_company_name, p.kg AS trade_volume_kg,
               100.0 * p.kg / t.kg AS import_share_pct
        FROM {pair_totals} AS p JOIN (SELECT buyer_id, sum(kg) AS kg FROM {pair_totals} GROUP BY buyer_id) AS t
        ON p.buyer_id = t.buyer_id""",
    "imported_hs": """
        SELECT g.company_id, g.hs_code, 100.0 * g.q / t.q AS import_share_pct
        FROM (SELECT buyer_id AS company_id, hs_code, sum(quantity) AS q FROM {shipments} GROUP BY buyer_id, hs_code) AS g
        JOIN (SELECT buyer_id AS company_id, sum(quantity) AS q FROM {shipments} GROUP BY buyer_id) AS t
        ON g.company_id = t.company_id""",
    "exported_hs": """
        SELECT g.company_id, g.hs_code, 100.0 * g.q / t.q AS export_share_pct
        FROM (SELECT supplier_id AS company_id, hs_code, sum(quantity) AS q FROM {shipments} GROUP BY supplier_id, hs_code) AS g
        JOIN (SELECT supplier_id AS company_id, sum(quantity) AS q FROM {shipments} GROUP BY supplier_id) AS t
        ON g.company_id = t.company_id""",
    "company_list": """
        SELECT buyer_id AS company_id, min(buyer_name) AS company_name, 'buyer' AS company_role,
               CAST(min(ship_date) AS DATE) AS from_date, CAST(max(ship_date) AS DATE) AS to_date,
               count(*) AS number_of_shipments, sum(quantity) AS shipment_value
        FROM {shipments} GROUP BY buyer_id
        UNION ALL
        SELECT supplier_id AS company_id, min(supplier_name) AS company_name, 'Supplier' AS company_role,
               CAST(min(ship_date) AS DATE) AS from_date, CAST(max(ship_date) AS DATE) AS to_date,
               count(*) AS number_of_shipments, sum(quantity) AS shipment_value
        FROM {shipments} GROUP BY supplier_id""",
    "external_health": """
        SELECT supplier_id, buyer_id, CAST(10 + n % 85 AS DOUBLE) AS trade_relationship_health,
               n AS total_shipment_count, CASE WHEN n % 2 = 0 THEN 'up' ELSE 'down' END AS shipment_trend
        FROM {pair_totals} WHERE n % 7 <> 0""",
    "buyer_countries": """
        SELECT DISTINCT 'B' || CAST(c.c_nationkey AS STRING) AS buyer_id, lower(n.n_name) AS country
        FROM {customer} AS c JOIN {nation} AS n ON c.c_nationkey = n.n_nationkey WHERE c.c_nationkey % 9 <> 4""",
    "firms": """
        SELECT org_id, industry, n * 3 % 500 AS employee_count, n % 6 AS intent_count,
               CASE WHEN n % 3 = 0 THEN 1 ELSE 0 END AS leadership_change,
               CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END AS funding_event,
               CASE WHEN n % 7 = 0 THEN 1 ELSE 0 END AS ma_event
        FROM (SELECT 'B' || CAST(c_nationkey AS STRING) AS org_id, min(c_mktsegment) AS industry, count(*) AS n
              FROM {customer} GROUP BY c_nationkey
              UNION ALL
              SELECT 'S' || CAST(s_nationkey AS STRING) AS org_id, 'supply' AS industry, count(*) AS n
              FROM {supplier} GROUP BY s_nationkey) AS f""",
    "people_links": """
        SELECT 'P' || CAST(s_suppkey AS STRING) AS person_key, 'S' || CAST(s_nationkey AS STRING) AS org_id
        FROM {supplier} WHERE s_suppkey % 4 = 0
        UNION ALL
        SELECT 'Q' || CAST(c_custkey AS STRING) AS person_key, 'B' || CAST(c_nationkey AS STRING) AS org_id
        FROM {customer} WHERE c_custkey % 50 = 0""",
    "people": """
        SELECT 'P' || CAST(s_suppkey AS STRING) AS person_key, s_name AS name, 'Sales' AS title,
               'p' || CAST(s_suppkey AS STRING) || '@x.example' AS email, FALSE AS is_decision_maker FROM {supplier}
        UNION ALL
        SELECT 'Q' || CAST(c_custkey AS STRING) AS person_key, c_name AS name, 'Head of Purchasing' AS title,
               'q' || CAST(c_custkey AS STRING) || '@x.example' AS email, c_custkey % 100 = 0 AS is_decision_maker
        FROM {customer}""",
    # --- signals ------------------------------------------------------------------------------
    "signals": """
        SELECT 'sig:e' || CAST(event_id AS STRING) AS signal_uid, 'raw:e' || CAST(event_id AS STRING) AS raw_uid,
               'web.events' AS source_key,
               CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'commercial_click_detected'
                    WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'lead_created' WHEN 1 THEN 'contact_enriched' ELSE 'news_trigger_detected' END
                    WHEN 'purchase' THEN CASE event_id % 3 WHEN 0 THEN 'deal_won' WHEN 1 THEN 'rfq_created' ELSE 'third_party_intent_detected' END
                    ELSE CASE event_id % 2 WHEN 0 THEN 'bot_detected' ELSE 'meeting_scheduled' END END AS signal_type,
               CASE event_type WHEN 'view' THEN 'WebsiteBehaviorSource' WHEN 'click' THEN 'WebsiteBehaviorSource'
                    WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'CRMSource' WHEN 1 THEN 'EnrichmentSource' ELSE 'ThirdPartyIntelligenceSource' END
                    WHEN 'purchase' THEN CASE event_id % 3 WHEN 0 THEN 'CRMSource' WHEN 1 THEN 'RFQInquirySource' ELSE 'ThirdPartyIntelligenceSource' END
                    ELSE 'BotDetectionSource' END AS source_family,
               ts AS occurred_at, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(0.4 + (event_id % 6) * 0.1 AS DOUBLE) END AS confidence_score,
               CASE WHEN event_id % 5 < 3 THEN 'U' || CAST(user_id AS STRING) || ' ' ELSE NULL END AS account_hint,
               CASE WHEN event_id % 4 = 0 THEN 'PU' || CAST(user_id AS STRING) ELSE NULL END AS person_hint,
               CASE WHEN event_id % 7 = 0 THEN 'd' || CAST(user_id AS STRING) || '.example' ELSE NULL END AS domain_hint,
               CASE WHEN event_id % 9 = 0 THEN 'x@y.example' ELSE NULL END AS email_hint, CAST(NULL AS STRING) AS phone_hint,
               CASE WHEN event_id % 2 = 0 THEN 'prod' ELSE NULL END AS product_hint,
               CASE WHEN event_id % 3 = 0 THEN 'cat' ELSE NULL END AS category_hint, CAST(NULL AS STRING) AS hs_code,
               CASE WHEN event_id % 6 = 1 THEN 's' || CAST(user_id AS STRING) ELSE NULL END AS session_id,
               CAST(event_id % 9 AS DOUBLE) AS number_of_shipments, value AS shipment_value
        FROM {events}
        UNION ALL
        SELECT 'sig:o' || CAST(o_orderkey AS STRING) AS signal_uid, 'raw:o' || CAST(o_orderkey AS STRING) AS raw_uid,
               'raw.trade_shipment_bl' AS source_key,
               CASE WHEN o_orderkey % 4 = 0 THEN 'active_importer_detected' ELSE 'shipment_detected' END AS signal_type,
               'TradeShipmentSource' AS source_family,
               TIMESTAMP '2024-02-02 00:00:00' - INTERVAL '1' DAY * (o_orderkey % 120) AS occurred_at,
               0.9 AS confidence_score, 'C' || CAST(o_custkey AS STRING) AS account_hint,
               CASE WHEN o_orderkey % 6 = 0 THEN 'PU' || CAST(o_custkey AS STRING) ELSE NULL END AS person_hint,
               CAST(NULL AS STRING) AS domain_hint, CAST(NULL AS STRING) AS email_hint, CAST(NULL AS STRING) AS phone_hint,
               CASE WHEN o_orderkey % 3 = 0 THEN 'prod' ELSE NULL END AS product_hint, CAST(NULL AS STRING) AS category_hint,
               CASE WHEN o_orderkey % 5 = 0 THEN '680299' ELSE NULL END AS hs_code, CAST(NULL AS STRING) AS session_id,
               CAST(o_orderkey % 12 AS DOUBLE) AS number_of_shipments, o_totalprice AS shipment_value
        FROM {orders}""",
    "accounts_known": """
        SELECT 'u' || CAST(user_id AS STRING) AS entity_id FROM (SELECT DISTINCT user_id FROM {events}) AS e
        UNION ALL SELECT 'C' || CAST(c_custkey AS STRING) AS entity_id FROM {customer} WHERE c_acctbal > 1000""",
    "persons_known": """
        SELECT 'pu' || CAST(user_id AS STRING) AS entity_id FROM (SELECT DISTINCT user_id FROM {events}) AS e""",
    "source_keys": """
        SELECT CASE e.event_id % 10 WHEN 0 THEN 'raw.trade_shipment_bl' WHEN 1 THEN 'CRM.rfqs' WHEN 2 THEN 'firmo.contact_enrich'
                 WHEN 3 THEN 'app_staging.enquiries' WHEN 4 THEN 'other.import_' || e.event_type WHEN 5 THEN 'web.click_' || e.event_type
                 WHEN 6 THEN 'x.deal_' || e.event_type WHEN 7 THEN 'y.scoop' WHEN 8 THEN 'z.intent' ELSE 'z.' || e.event_type END AS source_key, e.event_id
        FROM {events} AS e""",
    "shipment_rows": """
        SELECT o_orderkey AS shipment_id, 'C' || CAST(o_custkey AS STRING) AS importer_id, o_orderpriority AS product_name,
               CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '6802' END AS hs_code, CAST(o_orderkey % 7 AS STRING) || ',000' AS shipment_value,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:00:00' END AS shipment_date
        FROM {orders}""",
    "platform_pageviews": "SELECT event_id AS pageViewId, user_id AS userId, CAST(ts AS STRING) AS createdAt FROM {events} WHERE event_type = 'view'",
    "platform_rfqs": "SELECT o_orderkey AS rfqId, o_custkey AS user_id, 'P' || o_orderpriority AS productId FROM {orders} WHERE o_orderstatus = 'O'",
    "platform_leads": "SELECT event_id AS leadId, user_id AS accountId, 'P' || CAST(event_id % 9 AS STRING) AS contact_id, CASE WHEN event_id % 2 = 0 THEN event_id % 12 ELSE NULL END AS category_id, CAST(ts AS STRING) AS created_at FROM {events} WHERE event_type = 'signup'",
    "platform_meetings": "SELECT CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS meetingId, user_id, CAST(event_id % 50 AS STRING) AS personId FROM {events} WHERE event_type = 'purchase'",
    "platform_deals": "SELECT o_orderkey AS dealId, o_custkey AS userId, o_orderpriority AS product_id FROM {orders} WHERE o_orderstatus = 'P'",
    "vendor_keys": """
        SELECT CASE event_id % 6 WHEN 0 THEN 'RAW.vendora_shipment_bl' WHEN 1 THEN 'vendorb.contact_enrich' WHEN 2 THEN 'x.vendora_feed' WHEN 3 THEN 'y.vendorb_list' WHEN 4 THEN 'z.trade_feed' ELSE 'shop_staging.tracking_page_views' END AS source_key, event_id FROM {events}""",
    "signals_known": "SELECT 'signal:derived:PageView:' || CAST(event_id AS STRING) AS signal_uid FROM {events} WHERE user_id < 40",
    # --- organisations and outside reports ----------------------------------------------------
    "orgs": """
        SELECT 'C' || CAST(c.c_custkey AS STRING) AS org_id, c.c_name || ' ' || c.c_mktsegment || ' Ltd' AS org_name,
               CASE WHEN c.c_custkey % 6 = 0 THEN 'T' || CAST(c.c_custkey AS STRING) ELSE NULL END AS profile_tag,
               CASE WHEN c.c_custkey % 3 = 0 THEN 'c' || CAST(c.c_custkey % 40 AS STRING) || '.example' ELSE '' END AS domain,
               n.n_name AS country
        FROM {customer} AS c JOIN {nation} AS n ON c.c_nationkey = n.n_nationkey""",
    "profiles": """
        SELECT CASE o.o_orderkey % 4 WHEN 0 THEN 'C' || CAST(o.o_custkey AS STRING)
                    WHEN 1 THEN 'T' || CAST(o.o_custkey AS STRING)
                    ELSE 'N' || CAST(o.o_custkey AS STRING) END AS company_id,
               CASE WHEN o.o_orderkey % 4 = 3 THEN 'nobody' ELSE upper(c.c_name || ' ' || c.c_mktsegment || ' Ltd') END AS company_name,
               CAST(o.o_orderkey % 100 AS DOUBLE) AS trade_health_score, CAST(o.o_orderkey % 37 AS DOUBLE) AS supplier_risk_score,
               o.o_orderkey % 500 AS total_shipment_count, o.o_orderstatus AS company_type, o.o_orderdate AS modified_on
        FROM {orders} AS o JOIN {customer} AS c ON o.o_custkey = c.c_custkey""",
    "company_search": """
        SELECT CASE c_custkey % 10 WHEN 7 THEN substring(c_name, 1, 17) WHEN 3 THEN c_name || ' ' || c_mktsegment ELSE c_name END AS company_name,
               c_custkey % 900 AS employee_count, c_mktsegment AS industry,
               'c' || CAST(c_custkey % 45 AS STRING) || '.example' AS domain, CAST(c_nationkey AS STRING) AS country
        FROM {customer}""",
    "contact_rows": """
        SELECT CASE WHEN c_custkey % 3 = 0 THEN 'Ann' ELSE NULL END AS first_name,
               CASE WHEN c_custkey % 4 = 0 THEN 'Lee' ELSE '' END AS last_name,
               CASE WHEN c_custkey % 5 = 0 THEN c_name ELSE '' END AS full_name,
               CASE c_custkey % 4 WHEN 0 THEN 'VP Supply Chain' WHEN 1 THEN 'Sourcing Lead' WHEN 2 THEN 'Clerk' ELSE NULL END AS title,
               CASE WHEN c_custkey % 2 = 0 THEN 'm' || CAST(c_custkey AS STRING) || '@x.example' ELSE NULL END AS email,
               CAST(c_custkey AS STRING) AS phone, substring(c_name, 1, 17) AS company_name, 'senior' AS seniority_level
        FROM {customer}""",
    "intent_rows": """
        SELECT c.c_name AS company_name, p.p_type AS topic, CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS signal_date
        FROM {orders} AS o JOIN {customer} AS c ON o.o_custkey = c.c_custkey
        JOIN {lineitem} AS l ON l.l_orderkey = o.o_orderkey
        JOIN {part} AS p ON l.l_partkey = p.p_partkey""",
    "news_rows": """
        SELECT c.c_name AS company_name, d.text AS content, '2024-01-' || CAST(10 + d.doc_id % 20 AS STRING) AS news_date
        FROM {documents} AS d JOIN {customer} AS c ON c.c_custkey = d.doc_id % 100 + 1""",
    "scoop_rows": """
        SELECT c.c_name AS company_name, v.text AS content, '2024-01-' || CAST(10 + v.turn % 20 AS STRING) AS news_date
        FROM {conversations} AS v JOIN {customer} AS c ON c.c_custkey = v.conv_id % 120 + 1""",
}
# contacts under their company's whole name, not its first 17 characters
FIXTURES["named_contact_rows"] = FIXTURES["contact_rows"].replace("substring(c_name, 1, 17)", "c_name")
