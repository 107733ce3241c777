"""Fixtures and DuckDB statements for entities, governance, provenance and intelligence."""

from leadloom.checks.sqltext import sid

GRAPH_FIXTURES: dict[str, str] = {
    "g_accounts": """
        SELECT CAST(c_custkey AS STRING) AS account_id, c_custkey AS id, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE c_name END AS name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE ' A' || CAST(c_custkey % 700 AS STRING) || '@X.example' END AS email,
               CASE WHEN c_custkey % 3 = 0 THEN 'Buyer' ELSE NULL END AS default_role, CASE WHEN c_custkey % 2 = 0 THEN 'buyer ' ELSE c_mktsegment END AS user_type, CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE '' END AS username FROM {customer}""",
    "g_orgs": """
        SELECT CAST(s_suppkey AS STRING) AS org_id, s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_nationkey AS STRING) END AS group_id, s_suppkey * 2 AS user_id,
               CAST(NULL AS STRING) AS website, 'd' || CAST(s_suppkey AS STRING) || '.example' AS domain FROM {supplier}""",
    "g_groups": "SELECT CAST(n_nationkey AS STRING) AS group_id, n_nationkey AS id, n_name AS name FROM {nation} WHERE n_nationkey < 20",
    "g_stores": "SELECT CAST(s_suppkey AS STRING) AS org_id, 'store:' || CAST(s_suppkey AS STRING) AS store_id, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'shop' || CAST(s_suppkey AS STRING) END AS slug FROM {supplier} WHERE s_suppkey % 2 = 0",
    "account_orgs": "SELECT CAST(s_suppkey * 2 AS STRING) AS account_id, CAST(s_suppkey AS STRING) AS org_id FROM {supplier} WHERE s_suppkey % 5 <> 1",
    "g_products": """
        SELECT p_partkey AS id, p_partkey AS product_id, p_name AS title, p_brand AS brand, CASE WHEN p_size % 4 = 1 THEN NULL ELSE p_retailprice END AS price, CASE p_size % 5 WHEN 0 THEN NULL ELSE p_size % 5 END AS currency_id, p_size % 30 AS category_id, p_partkey % 120 AS supplier_id, CASE p_size % 3 WHEN 0 THEN ' kg ' WHEN 1 THEN 'm' ELSE '' END AS unit,
               p_type || '|' || p_name || ', ' || lower(p_type) || ';' || p_brand AS words, p_partkey % 900 AS user_id FROM {part}""",
    "g_categories": "SELECT n_nationkey + 1 AS id, n_regionkey AS parent_id, n_name AS name FROM {nation}",
    "g_use_cases": "SELECT n_nationkey AS use_case_id, CASE n_nationkey % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'Economy, small' ELSE 'Brand#3;promo' END AS words FROM {nation}",
    "deal_rows": "SELECT o_orderkey AS deal_id, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_custkey % 7 END AS pipeline_id, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 9 END AS stage_id, CAST(o_custkey AS STRING) AS account_id, o_totalprice AS amount, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status FROM {orders}",
    "instances": "SELECT CASE o_orderkey % 3 WHEN 0 THEN 'Buyer' WHEN 1 THEN 'Seller' ELSE 'Store' END AS entity, o_orderkey AS id, CAST(o_orderkey % 100 AS DOUBLE) / 100 AS confidence FROM {orders}",
    "taxonomy": "SELECT 'Buyer' AS entity, '>=0.65' AS gate UNION ALL SELECT 'Seller' AS entity, 'High' AS gate UNION ALL SELECT 'Org' AS entity, 'none' AS gate",
    "t_taxonomy": "SELECT r_name AS taxonomy, '0.' || CAST(r_regionkey + 1 AS STRING) AS gate FROM {region}",
    "t_subtypes": "SELECT r.r_name AS taxonomy, n.n_name AS subtype FROM {nation} AS n JOIN {region} AS r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey < 22",
    "t_entities": "SELECT n.n_name AS subtype, s.s_name AS entity FROM {supplier} AS s JOIN {nation} AS n ON s.s_nationkey = n.n_nationkey",
    "t_rules": "SELECT DISTINCT s_name AS entity, 'rule' || CAST(s_suppkey % 5 AS STRING) AS rule_id, 'x > 1' AS predicate FROM {supplier} WHERE s_suppkey % 2 = 0",
    "policy_rows": """
        SELECT o_orderkey AS id, 'm' || CAST(o_orderkey % 5 AS STRING) AS module, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'edit' END AS action, CASE o_orderkey % 7 WHEN 0 THEN 'deny' WHEN 1 THEN 'allow' ELSE '' END AS effect,
               CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '1' ELSE '' END AS deny, CASE WHEN o_orderkey % 2 = 0 THEN 'false' ELSE NULL END AS is_allowed, CASE o_orderkey % 11 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '' ELSE NULL END AS allow,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS user_id, CASE WHEN o_orderkey % 6 = 0 THEN o_custkey % 100 ELSE NULL END AS organization_id,
               CASE WHEN o_orderkey % 8 = 1 THEN o_custkey % 30 ELSE NULL END AS organization_group_id, CASE WHEN o_orderkey % 10 = 3 THEN 'store:' || CAST(o_custkey % 50 AS STRING) ELSE NULL END AS store_id FROM {orders}""",
    "override_rows": """
        SELECT o_orderkey AS id, 'm' || CAST(o_orderkey % 5 AS STRING) AS module, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'edit' END AS action, CASE o_orderkey % 4 WHEN 0 THEN 'deny' ELSE '' END AS effect,
               CASE o_orderkey % 5 WHEN 0 THEN 'False' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE '1' END AS is_allowed, CASE WHEN o_orderkey % 3 = 1 THEN o_custkey ELSE NULL END AS user_id,
               CASE WHEN o_orderkey % 3 = 2 THEN o_custkey % 100 ELSE NULL END AS organization_id, CASE WHEN o_orderkey % 7 = 2 THEN o_custkey % 30 ELSE NULL END AS organization_group_id,
               CASE o_orderkey % 6 WHEN 1 THEN ' Buyer ' WHEN 4 THEN 'BUILDING' ELSE NULL END AS role_name FROM {orders} WHERE o_orderkey % 5 = 0""",
    "feature_packages": "SELECT n_nationkey AS id, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE n_name END AS name, CASE WHEN n_nationkey % 8 = 0 THEN NULL ELSE 'Title ' || n_name END AS title, '' AS slug FROM {nation} WHERE n_nationkey < 20",
    "feature_plans": "SELECT o_custkey AS user_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 25 ELSE NULL END AS plan_id, o_orderkey % 23 AS feature_package_id FROM {orders}",
    "own_rules": "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'scope:group:' || CAST(o_custkey % 25 AS STRING) WHEN o_orderkey % 3 = 1 THEN 'scope:org:' || CAST(o_custkey % 100 AS STRING) ELSE 'scope:global' END AS scope_id, 'p' || CAST(o_orderkey % 40 AS STRING) AS permission, CASE WHEN o_orderkey % 50 = 0 THEN 'deny' ELSE 'allow' END AS effect FROM {orders}",
    "l_views": "SELECT CAST(user_id AS STRING) AS account_id, event_id AS id FROM {events} WHERE event_type = 'view'",
    "l_rfqs": "SELECT CAST(o_custkey AS STRING) AS account_id, o_orderkey AS id FROM {orders} WHERE o_orderstatus = 'O'",
    "l_deals": "SELECT CAST(o_custkey AS STRING) AS account_id, o_orderkey AS id FROM {orders} WHERE o_orderstatus = 'F'",
    "ll": "SELECT CAST(l_orderkey % 3000 AS STRING) AS lead_id, l_partkey % 50 AS a, l_suppkey % 7 AS b, l_linenumber AS c, CASE WHEN l_quantity > 25 THEN l_suppkey ELSE NULL END AS d FROM {lineitem} WHERE l_discount > 0.04",
    "lead_ids": "SELECT CAST(o_orderkey % 3500 AS STRING) AS lead_id FROM {orders}",
    "ip_visits": "SELECT event_id AS page_view_id, session_id, '10.1.' || CAST(user_id % 20 AS STRING) || '.1 ' AS ip FROM {activity} WHERE event_type = 'view'",
    "view_sources": "SELECT event_id AS page_view_id, 'src' || CAST(k AS STRING) AS source_id FROM {activity} WHERE event_type = 'view'",
    "lead_sources": "SELECT CAST(event_id AS STRING) AS lead_id, 'src' || CAST(k AS STRING) AS source_id FROM {activity} WHERE event_type = 'signup' AND k > 60",
    "seen_views": "SELECT event_id AS id, CASE WHEN k % 3 = 0 THEN NULL ELSE k END AS product_id, CASE WHEN k % 4 = 0 THEN NULL ELSE user_id END AS seller_id, CASE WHEN k % 5 = 0 THEN NULL ELSE value END AS time_spent FROM {activity}",
}


def _touch(kind: str, event: str, channel: str, score: float, weight: float, frm: str, key: str, at: str) -> str:
    return f"""SELECT '{kind}' AS kind, CAST({key} AS VARCHAR) AS source_ref, {sid("'lead_source'", f"'{kind}'", key)} AS source_id, {sid("'provenance_event'", f"'{kind}'", key)} AS event_id,
        {sid("'touch'", f"'{kind}'", key)} AS touch_id, {sid("'signal'", f"'{event}'", key)} AS signal_id, '{event}' AS event_type, {channel} AS channel, {score} AS touch_score, {weight} AS signal_weight, {at} AS event_at FROM {frm}"""


def _n(name: str, col: str, source: str = "{ll}", key: str = "lead_id") -> str:
    return f"{name} AS (SELECT {key}, count(DISTINCT {col}) AS n FROM {source} GROUP BY {key})"


GRAPH: dict[str, str] = {
    "entity_nodes": """
        SELECT 'Account' AS label, CAST(id AS VARCHAR) AS key, coalesce(nullif(name, ''), nullif(username, '')) AS name FROM {g_accounts} UNION ALL SELECT 'Organization' AS label, org_id AS key, name FROM {g_orgs}
        UNION ALL SELECT 'Store' AS label, 'store:' || org_id AS key, nullif(slug, '') AS name FROM {g_stores} UNION ALL SELECT 'Product' AS label, CAST(id AS VARCHAR) AS key, title AS name FROM {g_products}""",
    "account_emails": f"SELECT DISTINCT CAST(id AS VARCHAR) AS accountId, {sid(chr(39) + 'email' + chr(39), 'lower(trim(email))')} AS emailId, lower(trim(email)) AS email FROM {{g_accounts}} WHERE email IS NOT NULL",
    "entity_edges": """
        SELECT DISTINCT CAST(p.id AS VARCHAR) AS src, 'HAS_CATEGORY' AS kind, CAST(p.category_id AS VARCHAR) AS dst FROM {g_products} AS p JOIN {g_categories} AS c ON c.id = p.category_id
        UNION ALL SELECT CAST(o.user_id AS VARCHAR) AS src, 'OWNS' AS kind, o.org_id AS dst FROM {g_orgs} AS o JOIN {g_accounts} AS a ON a.id = o.user_id
        UNION ALL SELECT DISTINCT CAST(p.id AS VARCHAR) AS src, 'SUPPLIED_BY' AS kind, CAST(p.supplier_id AS VARCHAR) AS dst FROM {g_products} AS p JOIN {g_orgs} AS o ON o.id = p.supplier_id""",
    "split_keywords": """
        WITH w AS (SELECT product_id, trim(x) AS w, pos FROM (SELECT product_id, unnest(regexp_split_to_array(words, '[|,;\\n]+')) AS x, generate_subscripts(regexp_split_to_array(words, '[|,;\\n]+'), 1) AS pos FROM {g_products}) AS a WHERE trim(x) <> ''),
        f AS (SELECT product_id, arg_min(w, pos) AS w, min(pos) AS pos FROM w GROUP BY product_id, lower(w))
        SELECT product_id, string_agg(w, ',' ORDER BY pos) AS keywords FROM f GROUP BY product_id""",
    "pw": "SELECT DISTINCT product_id, lower(trim(x)) AS k FROM (SELECT product_id, unnest(regexp_split_to_array(words, '[|,;\\n]+')) AS x FROM {g_products}) AS a",
    "uw": "SELECT DISTINCT use_case_id, lower(trim(x)) AS k FROM (SELECT use_case_id, unnest(regexp_split_to_array(words, '[|,;\\n]+')) AS x FROM {g_use_cases}) AS a",
    "keyword_use_cases": "SELECT DISTINCT p.product_id, u.use_case_id FROM {pw} AS p JOIN {uw} AS u ON p.k = u.k",
    "seller_products": "SELECT DISTINCT o.org_id, p.product_id FROM {g_products} AS p JOIN {account_orgs} AS o ON o.account_id = CAST(p.user_id AS VARCHAR)",
    "category_tree": """
        WITH RECURSIVE t AS (SELECT id AS root, id AS node, parent_id AS parent, name, 0 AS level FROM {g_categories} WHERE parent_id = 0 UNION ALL SELECT t.root, c.id, c.parent_id, c.name, t.level + 1 AS level FROM {g_categories} AS c JOIN t ON c.parent_id = t.node) SELECT * FROM t""",
    "classify_accounts": """
        WITH l AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS a, 'Seller' AS label FROM {g_orgs} UNION SELECT DISTINCT account_id AS a, 'Buyer' AS label FROM {l_rfqs}), k AS (SELECT l.* FROM l JOIN {g_accounts} AS g ON g.account_id = l.a)
        SELECT 'Account' AS entity, a AS id, label FROM k UNION ALL SELECT DISTINCT 'Person' AS entity, 'p' || CAST(CAST(a AS BIGINT) // 2 AS VARCHAR) AS id, label FROM k""",
    "derived_units": f"""
        WITH u AS (SELECT product_id, nullif(trim(coalesce(unit, '')), '') AS unit, CAST(price AS VARCHAR) AS price, CAST(currency_id AS VARCHAR) AS currency, {sid("'unit'", "trim(coalesce(unit, ''))", "coalesce(CAST(price AS VARCHAR), '')")} AS unit_id FROM {{g_products}} WHERE trim(coalesce(unit, '')) <> '' OR price IS NOT NULL)
        SELECT DISTINCT product_id, unit_id, unit, price, max(currency) OVER (PARTITION BY unit_id) AS currency FROM u""",
    "derived_pipelines": """
        SELECT CAST(deal_id AS VARCHAR) AS src, 'IN_PIPELINE' AS kind, CAST(pipeline_id AS VARCHAR) AS dst FROM {deal_rows} WHERE pipeline_id IS NOT NULL
        UNION SELECT CAST(pipeline_id AS VARCHAR) AS src, 'HAS_STAGE' AS kind, CAST(stage_id AS VARCHAR) AS dst FROM {deal_rows} WHERE pipeline_id IS NOT NULL AND stage_id IS NOT NULL
        UNION SELECT o.org_id AS src, 'OWNS_PIPELINE' AS kind, CAST(d.pipeline_id AS VARCHAR) AS dst FROM {deal_rows} AS d JOIN {account_orgs} AS o ON o.account_id = d.account_id WHERE d.pipeline_id IS NOT NULL""",
    "confidence_gate": """
        SELECT i.entity, i.id, i.confidence, CASE i.entity WHEN 'Buyer' THEN 0.65 WHEN 'Seller' THEN 0.9 END AS required, CASE i.entity WHEN 'Buyer' THEN confidence >= 0.65 WHEN 'Seller' THEN confidence >= 0.9 ELSE TRUE END AS passed FROM {instances} AS i""",
    "validate_entities": f"""
        SELECT {sid("'rule_result'", "r", "'Account'", "id")} AS result_id, 'Account' AS entity, CAST(id AS VARCHAR) AS instance_id, r AS rule_id, ok AS check_passed, NOT ok AS needs_review, CASE WHEN ok THEN t ELSE t / 2 END AS confidence FROM (
          SELECT id, 'has_name' AS r, 0.9 AS t, coalesce(name <> '', FALSE) AS ok FROM {{g_accounts}} UNION ALL SELECT id, 'has_email' AS r, 0.6 AS t, coalesce(email LIKE '%@%', FALSE) AS ok FROM {{g_accounts}}) AS x""",
    "governance_chain": """
        SELECT t.taxonomy, t.gate, s.subtype, e.entity, r.rule_id, r.predicate FROM {t_taxonomy} AS t LEFT JOIN {t_subtypes} AS s ON s.taxonomy = t.taxonomy LEFT JOIN {t_entities} AS e ON e.subtype = s.subtype LEFT JOIN {t_rules} AS r ON r.entity = e.entity""",
    "contexts": """
        WITH w AS (SELECT account_id, name AS a, coalesce(nullif(default_role, ''), nullif(user_type, '')) AS role FROM {g_accounts}), o AS (SELECT w.*, ao.org_id, g.name AS o FROM {account_orgs} AS ao JOIN w ON w.account_id = ao.account_id JOIN {g_orgs} AS g ON g.org_id = ao.org_id)
        SELECT 'ctx:account:' || account_id AS context_id, 'account' AS context_type, coalesce(nullif(a, ''), 'Account Context') AS name, coalesce(role, 'account_owner') AS role_name FROM w
        UNION ALL SELECT 'ctx:org:' || account_id || ':' || org_id AS context_id, 'organization' AS context_type, o AS name, coalesce(role, 'organization_operator') AS role_name FROM o
        UNION ALL SELECT 'ctx:store:' || o.account_id || ':' || s.store_id AS context_id, 'store' AS context_type, coalesce(nullif(s.slug, ''), o.o) AS name, coalesce(o.role, 'store_operator') AS role_name FROM o JOIN {g_stores} AS s ON s.org_id = o.org_id""",
    "roles": "SELECT account_id, lower(default_role) AS role FROM {g_accounts} WHERE default_role IS NOT NULL UNION SELECT account_id, lower(trim(user_type)) AS role FROM {g_accounts}",
    "scopes": """
        SELECT 'scope:account:' || account_id AS scope_id, 'account' AS scope_type, 'scope:global' AS parent_id FROM {g_accounts} UNION ALL SELECT 'scope:group:' || group_id AS scope_id, 'organization_group' AS scope_type, 'scope:global' AS parent_id FROM {g_groups}
        UNION ALL SELECT 'scope:org:' || org_id AS scope_id, 'organization' AS scope_type, CASE WHEN group_id IS NULL THEN 'scope:global' ELSE 'scope:group:' || group_id END AS parent_id FROM {g_orgs}
        UNION ALL SELECT 'scope:store:' || store_id AS scope_id, 'store' AS scope_type, 'scope:org:' || org_id AS parent_id FROM {g_stores}""",
    "policies": f"""
        WITH p AS (SELECT *, module || ':' || coalesce(nullif(action, ''), 'access') AS permission, CASE WHEN effect <> '' THEN effect WHEN deny <> '' THEN CASE deny WHEN '0' THEN 'allow' ELSE 'deny' END WHEN is_allowed IS NOT NULL THEN 'deny' WHEN allow = '0' THEN 'deny' ELSE 'allow' END AS eff FROM {{policy_rows}}),
        s AS (SELECT *, 'scope:global' AS scope_id FROM p UNION ALL SELECT *, 'scope:account:' || CAST(user_id AS VARCHAR) AS scope_id FROM p WHERE user_id IS NOT NULL UNION ALL SELECT *, 'scope:org:' || CAST(organization_id AS VARCHAR) AS scope_id FROM p WHERE organization_id IS NOT NULL
            UNION ALL SELECT *, 'scope:group:' || CAST(organization_group_id AS VARCHAR) AS scope_id FROM p WHERE organization_group_id IS NOT NULL UNION ALL SELECT *, 'scope:store:' || store_id AS scope_id FROM p WHERE store_id IS NOT NULL)
        SELECT {sid("'policy_rule'", "'permissions'", "id")} AS policy_id, {sid("'permission'", "permission")} AS permission_id, permission, eff AS effect, scope_id FROM s""",
    "permission_overrides": f"""
        WITH p AS (SELECT *, module || ':' || coalesce(nullif(action, ''), 'access') AS permission, CASE WHEN effect <> '' THEN effect WHEN is_allowed IN ('', 'False') THEN 'deny' ELSE 'allow' END AS eff, lower(trim(role_name)) AS role FROM {{override_rows}}),
        s AS (SELECT *, 'scope:global' AS scope_id FROM p UNION ALL SELECT *, 'scope:account:' || CAST(user_id AS VARCHAR) AS scope_id FROM p WHERE user_id IS NOT NULL UNION ALL SELECT *, 'scope:org:' || CAST(organization_id AS VARCHAR) AS scope_id FROM p WHERE organization_id IS NOT NULL
            UNION ALL SELECT *, 'scope:group:' || CAST(organization_group_id AS VARCHAR) AS scope_id FROM p WHERE organization_group_id IS NOT NULL)
        SELECT {sid("'override'", "'custom_role_permission_overrides'", "id")} AS policy_id, {sid("'permission'", "permission")} AS permission_id, permission, eff AS effect, scope_id, role,
               'scope:account:' || CAST(user_id AS VARCHAR) AS account_scope FROM s""",
    "capabilities": "SELECT CAST(id AS VARCHAR) AS capability_id, coalesce(nullif(name, ''), title, 'capability:' || CAST(id AS VARCHAR)) AS name FROM {feature_packages}",
    "enabled_capabilities": """
        WITH b AS (SELECT DISTINCT CAST(p.user_id AS VARCHAR) AS account_id, CAST(f.id AS VARCHAR) AS capability_id FROM {feature_plans} AS p JOIN {feature_packages} AS f ON f.id = coalesce(p.plan_id, p.feature_package_id))
        SELECT 'account' AS owner_kind, account_id AS owner_id, capability_id FROM b UNION SELECT 'organization' AS owner_kind, o.org_id AS owner_id, b.capability_id FROM b JOIN {account_orgs} AS o ON o.account_id = b.account_id""",
    "resolved_permissions": """
        WITH up AS (SELECT DISTINCT scope_id, parent_id FROM {scopes}),
        c AS (SELECT scope_id, scope_id AS anc, 0 AS d FROM up UNION ALL SELECT scope_id, parent_id AS anc, 1 AS d FROM up UNION ALL SELECT s.scope_id, p.parent_id AS anc, 2 AS d FROM up AS s JOIN up AS p ON p.scope_id = s.parent_id
            UNION ALL SELECT s.scope_id, q.parent_id AS anc, 3 AS d FROM up AS s JOIN up AS p ON p.scope_id = s.parent_id JOIN up AS q ON q.scope_id = p.parent_id),
        r AS (SELECT scope_id, permission, effect, policy_id, 2 AS place FROM {policies} UNION ALL SELECT scope_id, permission, effect, policy_id, 1 AS place FROM {permission_overrides} WHERE role IS NULL
            UNION ALL SELECT DISTINCT o.account_scope AS scope_id, o.permission, o.effect, o.policy_id, 0 AS place FROM {permission_overrides} AS o JOIN {roles} AS h ON 'scope:account:' || h.account_id = o.account_scope AND lower(h.role) = o.role),
        f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY scope_id, permission ORDER BY place, CASE WHEN effect = 'deny' THEN 0 ELSE 1 END, policy_id) = 1)
        SELECT c.scope_id, f.permission, f.effect, c.d AS distance, f.policy_id, f.place < 2 AS is_override FROM c JOIN f ON f.scope_id = c.anc
        QUALIFY row_number() OVER (PARTITION BY c.scope_id, f.permission ORDER BY c.d) = 1""",
    "effective_permissions": """
        WITH RECURSIVE c AS (SELECT scope_id, scope_id AS anc FROM {scopes} UNION ALL SELECT s.scope_id, s.parent_id AS anc FROM {scopes} AS s UNION ALL
            SELECT s.scope_id, p.parent_id AS anc FROM {scopes} AS s JOIN {scopes} AS p ON p.scope_id = s.parent_id UNION ALL
            SELECT s.scope_id, q.parent_id AS anc FROM {scopes} AS s JOIN {scopes} AS p ON p.scope_id = s.parent_id JOIN {scopes} AS q ON q.scope_id = p.parent_id)
        SELECT c.scope_id, r.permission, CASE WHEN bool_or(r.effect = 'deny') THEN 'deny' ELSE 'allow' END AS effect FROM c JOIN {own_rules} AS r ON r.scope_id = c.anc GROUP BY c.scope_id, r.permission""",
    "provenance_touches": _touch("page_visit", "page_view", "'web'", 1.0, 1.0, "{events} WHERE event_type = 'view'", "event_id", "ts") + " UNION ALL "
        + _touch("rfq", "rfq_created", "lower(o_orderpriority)", 3.0, 4.0, "{orders}", "o_orderkey", "o_orderdate") + " UNION ALL "
        + _touch("lead", "lead_created", "lower(c_mktsegment)", 4.0, 4.0, "{customer}", "c_custkey", "TIMESTAMP '2024-01-02 00:00:00'") + " UNION ALL "
        + _touch("thread", "thread_created", "''", 3.0, 2.0, "{part}", "p_partkey", "TIMESTAMP '2024-01-03 00:00:00'"),
    "ip_identities": f"""
        WITH s AS (SELECT ip_address AS ip, 'ui' AS source, max(created_at) AS seen, 0 AS place FROM {{sessions}} GROUP BY ip_address UNION ALL SELECT trim(ip) AS ip, 'crm' AS source, CAST(NULL AS TIMESTAMP) AS seen, 1 AS place FROM {{ip_visits}} GROUP BY trim(ip))
        SELECT {sid("'ip'", "ip")} AS ip_id, ip, source, seen AS last_seen FROM s QUALIFY row_number() OVER (PARTITION BY ip ORDER BY place DESC) = 1""",
    "session_addresses": f"SELECT DISTINCT session_id, {sid("'ip'", "ip_address")} AS ip_id FROM {{{{sessions}}}}".replace("{{", "{").replace("}}", "}"),
    "device_identity": f"""
        WITH v AS (SELECT DISTINCT session_id, trim(ip) AS ip FROM {{ip_visits}}), x AS (SELECT v.*, s.user_agent AS ua FROM v LEFT JOIN {{sessions}} AS s ON s.session_id = v.session_id WHERE v.session_id NOT IN (SELECT session_id FROM {{sessions}} WHERE user_id > 0))
        SELECT session_id, {sid("'anon_visitor'", "session_id")} AS visitor_id, {sid("'ip'", "ip")} AS ip_id, {sid("'fingerprint'", "ip", "ua")} AS fingerprint_id, {sid("'ghost_profile'", sid("'anon_visitor'", "session_id"))} AS profile_id, 0.55 AS confidence FROM x""",
    "ghost_to_lead": "SELECT DISTINCT d.profile_id, l.lead_id FROM {device_identity} AS d JOIN {ip_visits} AS v ON v.session_id = d.session_id JOIN {view_sources} AS s ON s.page_view_id = v.page_view_id JOIN {lead_sources} AS l ON l.source_id = s.source_id",
    "account_intent": f"""
        WITH {_n('v', 'id', '{l_views}', 'account_id')}, {_n('r', 'id', '{l_rfqs}', 'account_id')}, {_n('d', 'id', '{l_deals}', 'account_id')},
        x AS (SELECT a.account_id, coalesce(v.n, 0) AS page_views, coalesce(r.n, 0) AS rfqs, coalesce(d.n, 0) AS deals FROM {{g_accounts}} AS a LEFT JOIN v ON v.account_id = a.account_id LEFT JOIN r ON r.account_id = a.account_id LEFT JOIN d ON d.account_id = a.account_id)
        SELECT 'intent:account:' || account_id AS intent_id, account_id, page_views, rfqs, deals, CASE WHEN rfqs + deals > 0 THEN 'commercial_buying' ELSE 'behavioral_interest' END AS intent_type, page_views + 5 * rfqs + 8 * deals AS score FROM x WHERE page_views + rfqs + deals > 0""",
    "intent_signals": """
        SELECT i.intent_id, 'signal:pv-intent:' || v.id AS signal_id, 'page_view' AS signal_type, 1.0 AS weight FROM {account_intent} AS i JOIN {l_views} AS v ON v.account_id = i.account_id UNION ALL SELECT i.intent_id, 'signal:rfq-intent:' || v.id AS signal_id, 'rfq_created' AS signal_type, 5.0 AS weight FROM {account_intent} AS i JOIN {l_rfqs} AS v ON v.account_id = i.account_id
        UNION ALL SELECT i.intent_id, 'signal:deal-intent:' || v.id AS signal_id, 'deal_progress' AS signal_type, 8.0 AS weight FROM {account_intent} AS i JOIN {l_deals} AS v ON v.account_id = i.account_id""",
    "lead_counts": f"""
        WITH {_n('a', 'a')}, {_n('b', 'b')}, {_n('c', 'c')}, {_n('d', 'd')} SELECT l.lead_id, coalesce(a.n, 0) AS a, coalesce(b.n, 0) AS b, coalesce(c.n, 0) AS c, coalesce(d.n, 0) AS d FROM (SELECT DISTINCT lead_id FROM {{lead_ids}}) AS l
        LEFT JOIN a ON a.lead_id = l.lead_id LEFT JOIN b ON b.lead_id = l.lead_id LEFT JOIN c ON c.lead_id = l.lead_id LEFT JOIN d ON d.lead_id = l.lead_id""",
    "lead_prediction": "SELECT lead_id, a AS rfqs, b AS deals, c AS threads, d AS sources, a AS touches, 24 * a + 35 * b + 8 * c + 5 * d AS score, d + a + b + a AS evidence_count, (d + a + b + a) / 10.0 AS truth_confidence FROM {lead_counts}",
    "org_evidence": "SELECT lead_id AS org_id, a AS sells, b AS facilities, c AS supplied, d AS target_views, a + b + c + d AS evidence_count, (a + b + c + d) / 10.0 AS confidence, a + b + c AS source_depth FROM {lead_counts}",
    "competitor_brands": """
        WITH x AS (SELECT DISTINCT s.org_id, p.brand FROM {g_stores} AS s JOIN {seller_products} AS sp ON sp.org_id = s.org_id JOIN {g_products} AS p ON p.product_id = sp.product_id)
        SELECT 'competitor:' || org_id || ':' || replace(lower(brand), ' ', '_') AS competitor_id, org_id, brand, count(*) OVER (PARTITION BY org_id) AS evidence_score FROM x""",
    "interest_findings": "SELECT 'finding:pageview:' || id AS finding_id, product_id, seller_id, 'product_interest' AS finding_type, coalesce(time_spent, 0) + 1 AS score FROM {seen_views} WHERE product_id IS NOT NULL AND seller_id IS NOT NULL",
    "buyer_committees": """
        WITH o AS (SELECT l.lead_id, min(ao.org_id) AS org_id FROM {ll} AS l JOIN {account_orgs} AS ao ON ao.account_id = CAST(l.a AS VARCHAR) GROUP BY l.lead_id),
        n AS (SELECT lead_id, count(DISTINCT a) AS a, count(DISTINCT b) AS b, count(DISTINCT d) AS d FROM {ll} GROUP BY lead_id)
        SELECT 'committee:' || n.lead_id AS committee_id, n.lead_id, n.a AS size, n.b AS threads, n.d AS meetings, (n.a + n.b + n.d) / 10.0 AS confidence, o.org_id FROM n LEFT JOIN o ON o.lead_id = n.lead_id WHERE n.a > 0 AND (n.b > 0 OR n.d > 0)""",
    "deal_prediction": """
        SELECT d.deal_id, CASE WHEN d.stage_id IS NULL THEN 0 ELSE 1 END AS stages, coalesce(g.n, 0) AS legs, d.amount, coalesce(d.status, 'unknown') AS escrow_status,
               CASE WHEN d.stage_id IS NULL THEN 0 ELSE 10 END + 20 + 4 * coalesce(g.n, 0) + CASE WHEN d.amount > 0 THEN 10 ELSE 0 END AS score
        FROM {deal_rows} AS d LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n FROM {lineitem} GROUP BY l_orderkey) AS g ON g.l_orderkey = d.deal_id""",
    "lead_waterfall": "SELECT lead_id, a AS source_depth, b AS rfqs, c AS deals, d AS threads, a + b + c + d AS evidence_count FROM {lead_counts}",
    "next_best_action": """
        SELECT 'dispatch:lead:' || lead_id AS dispatcher_id, CASE WHEN d > 0 THEN 'high' WHEN b > 0 THEN 'medium' ELSE 'normal' END AS priority,
               CASE WHEN d > 0 AND c = 0 THEN 'create_followup_task' WHEN b > 0 THEN 'continue_thread_nurture' WHEN a > 0 THEN 'assign_to_seller' ELSE 'research_lead' END AS action FROM {lead_counts}
        UNION ALL SELECT 'dispatch:thread:' || b AS dispatcher_id, 'medium' AS priority, 'link_thread_to_lead_workflow' AS action FROM {ll} GROUP BY b""",
}
