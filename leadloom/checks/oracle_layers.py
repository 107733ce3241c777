"""DuckDB statements for sources, sinks and layer jobs."""

from leadloom.checks.sqltext import sid

_key = "sha256(concat_ws('|', coalesce(company_id, ''), coalesce(country, ''), coalesce(zip_code, ''), coalesce(matched_hs_codes, ''), coalesce(company_role, '')))"
_req = "sha256(lower(concat_ws('|', coalesce(title, ''), coalesce(description, ''), coalesce(country, ''), coalesce(direction, ''))))"

LAYERS: dict[str, str] = {
    "read_landed_json": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {orders}",
    "path_fields": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Buyer' ELSE 'supplier' END AS company_role, DATE '2024-01-01' AS from_date,
               DATE '2024-03-31' AS to_date FROM {orders}""",
    "partitioned_table_read": """
        WITH p AS (SELECT count(*) AS n, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM {lineitem}),
        q AS (SELECT lo, hi, greatest(1, least(CAST(floor(n / 20000.0) AS BIGINT) + 1, 50)) AS k FROM p),
        w AS (SELECT *, CAST(ceil((hi - lo + 1) / CAST(k AS DOUBLE)) AS BIGINT) AS width FROM q),
        r AS (SELECT unnest(range(0, k)) AS split, lo, width FROM w)
        SELECT r.split, r.lo + r.split * r.width AS lower, r.lo + (r.split + 1) * r.width AS upper, count(l.l_orderkey) AS rows
        FROM r LEFT JOIN {lineitem} AS l ON l.l_orderkey >= r.lo + r.split * r.width AND l.l_orderkey < r.lo + (r.split + 1) * r.width
        GROUP BY r.split, r.lo, r.width""",
    "resolve_columns": """
        SELECT CAST(consignee_id AS VARCHAR) AS buyer_id, consignee_name AS buyer_name, CAST(shipper_id AS VARCHAR) AS supplier_id,
               CAST(NULL AS VARCHAR) AS supplier_name, HSCode AS hs_code, net_weight AS quantity, fob_value AS value, bl_date AS ship_date FROM {bills}""",
    "incremental_since": """
        SELECT event_id, ts, user_id FROM {events} WHERE ts > TIMESTAMP '2024-01-20 00:00:00'
           OR (ts = TIMESTAMP '2024-01-20 00:00:00' AND event_id > 100)""",
    "new_watermark": """
        SELECT max(ts) AS watermark, arg_max(event_id, ts) AS last_id, count(*) AS rows_read FROM {incremental_since}""",
    "append_new_keys": "SELECT * FROM {new_table} WHERE company_id NOT IN (SELECT company_id FROM {old_table})",
    "warehouse_shape": """
        SELECT l_orderkey AS order_id, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS lines,
               concat('{"first":', min(l_linenumber), ',"last":', max(l_linenumber), '}') AS span FROM {lineitem} GROUP BY l_orderkey""",
    "node_edge_sink": """
        SELECT DISTINCT src, dst FROM (SELECT CAST(c_nationkey AS VARCHAR) AS src, CAST(c_custkey AS VARCHAR) AS dst FROM {customer}
          UNION ALL SELECT CAST(s_nationkey AS VARCHAR) AS src, CAST(s_suppkey AS VARCHAR) AS dst FROM {supplier}) AS u""",
    "outbox_events": f"""
        SELECT rel_id AS aggregate_id, {sid("'outbox'", "'trade_relationship.health_updated'", "rel_id")} AS event_id,
               'trade_relationship.health_updated' AS event_type, TIMESTAMP '2001-11-05 00:00:00' AS created_at, FALSE AS processed,
               concat('{{"rel_id":"', rel_id, '","buyer_id":"', buyer_id, '","total_shipments":', total_shipments, '}}') AS payload
        FROM {{trade_relationships}}""",
    "load_log": """
        SELECT coalesce(r.feed_name, o.feed_name) AS feed_name, coalesce(r.run_at, o.last_run_at) AS last_run_at,
               CASE WHEN r.status = 'success' THEN r.run_at ELSE o.last_success_at END AS last_success_at,
               coalesce(r.records_loaded, o.records_loaded) AS records_loaded, coalesce(r.status, o.status) AS status, r.error_msg
        FROM {pending_runs} AS r FULL OUTER JOIN {old_log} AS o ON r.feed_name = o.feed_name""",
    "flatten_array": "SELECT order_id, line, CAST(supplier AS VARCHAR) AS supplier, quantity, flag FROM {flat_lines}",
    "flatten_nested_array": "SELECT order_id, flag, line, quantity FROM {flat_lines}",
    "flatten_struct": "SELECT o_orderkey AS order_id, o_custkey AS buyer, o_orderstatus AS state, CAST(o_orderdate AS DATE) AS day FROM {orders}",
    "json_side_columns": "SELECT o_orderkey, concat('{\"customer\":', o_custkey, ',\"status\":\"', o_orderstatus, '\"}') AS side FROM {orders}",
    "family_tree_rows": """
        WITH RECURSIVE t AS (SELECT node AS root, node, parent, name, 0 AS level FROM {tree_edges} WHERE parent = 0
          UNION ALL SELECT t.root, e.node, e.parent, e.name, t.level + 1 AS level FROM {tree_edges} AS e JOIN t ON e.parent = t.node)
        SELECT *, CASE WHEN level = 0 THEN 'root' ELSE 'subsidiary' END AS node_type FROM t""",
    "family_tree_json": """
        SELECT r_regionkey AS root, r_regionkey AS node, 0 AS parent, 0 AS level, 'root' AS node_type, r_name AS name FROM {region}
        UNION ALL SELECT n_regionkey AS root, n_nationkey AS node, n_regionkey AS parent, 1 AS level, CASE WHEN n_regionkey = 0 THEN 'parent' ELSE 'subsidiary' END AS node_type, n_name AS name FROM {nation}
        UNION ALL SELECT n_regionkey AS root, s_suppkey AS node, n_nationkey AS parent, 2 AS level, CASE WHEN n_nationkey = 0 THEN 'parent' ELSE 'subsidiary' END AS node_type, s_name AS name
          FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
        UNION ALL SELECT r_regionkey AS root, r_regionkey AS node, 99 AS parent, -1 AS level, 'parentage' AS node_type, 'World' AS name FROM {region}""",
    "explode_topics_or_self": """
        SELECT o.o_orderkey AS id, l.l_returnflag AS topic, l.l_quantity AS score FROM {orders} AS o JOIN {lineitem} AS l ON o.o_orderkey = l.l_orderkey
        UNION ALL SELECT o_orderkey AS id, o_orderstatus AS topic, o_totalprice AS score FROM {orders} WHERE o_orderkey NOT IN (SELECT l_orderkey FROM {lineitem})""",
    "hash_key": f"SELECT id, {_req} AS hash_key, sha256(concat_ws('|', coalesce(title, ''), coalesce(description, ''))) AS plain_key FROM {{requests}}",
    "dedup_best": f"""
        SELECT *, {_key} AS hash_key FROM {{bronze_list}} QUALIFY row_number() OVER (PARTITION BY {_key}
          ORDER BY number_of_shipments DESC, company_id DESC, country DESC, zip_code DESC NULLS LAST, matched_hs_codes DESC, company_role DESC, shipment_value DESC, ingested_at DESC) = 1""",
    "keyed_merge": """
        SELECT coalesce(n.company_id, o.company_id) AS company_id, coalesce(n.name, o.name) AS name, coalesce(n.balance, o.balance) AS balance,
               coalesce(n.origin, o.origin) AS origin, coalesce(o.created_on, n.created_on) AS created_on, coalesce(o.created_by, n.created_by) AS created_by,
               coalesce(n.modified_on, o.modified_on) AS modified_on, coalesce(n.modified_by, o.modified_by) AS modified_by
        FROM {old_table} AS o FULL OUTER JOIN {new_table} AS n ON o.company_id = n.company_id""",
    "surrogate_key": """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS line_key, l_orderkey, l_linenumber, l_partkey FROM {lineitem}""",
    "gold_upsert": """
        SELECT coalesce(g.cp_key, (SELECT max(cp_key) FROM {old_gold}) + row_number() OVER (PARTITION BY g.cp_key IS NULL ORDER BY s.company_id)) AS cp_key,
               coalesce(s.company_id, g.company_id) AS company_id, coalesce(s.name, g.name) AS name
        FROM {gold_silver} AS s FULL OUTER JOIN {old_gold} AS g ON s.company_id = g.company_id""",
    "audit_columns": """
        SELECT r_regionkey, TIMESTAMP '2024-01-31 00:00:00' AS created_on, 'feed' AS created_by, TIMESTAMP '2024-01-31 00:00:00' AS modified_on, 'feed' AS modified_by FROM {region}""",
    "pairs_from_roles": """
        SELECT DISTINCT b.company_id AS buyer_id, s.company_id AS supplier_id FROM {company_list} AS b JOIN {imported_hs} AS i ON b.company_id = i.company_id
        JOIN {exported_hs} AS e ON i.hs_code = e.hs_code JOIN {company_list} AS s ON s.company_id = e.company_id
        WHERE lower(b.company_role) = 'buyer' AND lower(s.company_role) = 'supplier'""",
    "not_yet_enriched": """
        SELECT * FROM {contact_scores} WHERE (contact_accuracy_score IS NULL OR contact_accuracy_score >= 60) AND contact_id NOT IN (SELECT contact_id FROM {enriched})""",
    "normalise_health": """
        SELECT CAST(o_custkey AS VARCHAR) AS buyer_id, CAST(o_orderkey AS VARCHAR) AS supplier_id, CAST(o_orderkey % 90 AS DOUBLE) AS health_score,
               o_orderkey % 9 AS shipment_count, CASE WHEN o_orderkey % 3 = 2 THEN 'unknown' ELSE o_orderstatus END AS health_status FROM {orders}""",
    "classification_rows": f"""
        SELECT {_req} AS hash_key, CAST(id AS VARCHAR) AS most_suitable_hs_code, title AS most_suitable_hs_description,
               CASE WHEN size % 2 = 0 THEN '' ELSE 'alt' || CAST(id AS VARCHAR) END AS dutiable_hs_code, CASE WHEN size % 2 = 0 THEN '' ELSE 'other' END AS dutiable_hs_description
        FROM {{requests}}""",
    "list_to_text": """
        SELECT l_orderkey AS order_id, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS ids,
               string_agg(l_returnflag, ',' ORDER BY l_linenumber) AS names, min(l_linenumber) AS first_id FROM {distinct_lines} GROUP BY l_orderkey""",
    "distinct_lines": "SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM {lineitem} GROUP BY l_orderkey, l_linenumber",
    "parse_dates": "SELECT id, TRY_CAST(substr(raw, 1, 10) AS DATE) AS day, TRY_CAST(substr(raw, 1, 19) AS TIMESTAMP) AS moment FROM {date_texts}",
    "feed_job": f"""
        WITH s AS (SELECT * FROM {{dedup_best}})
        SELECT row_number() OVER (ORDER BY hash_key) AS bsl_key, hash_key, company_id, country, zip_code, matched_hs_codes, company_role,
               number_of_shipments, shipment_value, ingested_at, TIMESTAMP '2024-01-31 00:00:00' AS created_on, 'feed' AS created_by FROM s""",
}
