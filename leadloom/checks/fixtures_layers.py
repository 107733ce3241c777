"""Inputs of the source, sink and layer operators (SQL for Spark and DuckDB)."""

LAYER_FIXTURES: dict[str, str] = {
    "flat_lines": """
        SELECT l_orderkey AS order_id, l_linenumber AS line, l_suppkey AS supplier, l_quantity AS quantity,
               l_returnflag AS flag, l_shipdate AS shipped FROM {lineitem}""",
    "bronze_list": """
        SELECT CAST(o.o_custkey AS STRING) AS company_id, n.n_name AS country,
               CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE CAST(o.o_custkey % 7 AS STRING) END AS zip_code,
               o.o_orderstatus AS matched_hs_codes, CASE WHEN o.o_orderkey % 2 = 0 THEN 'buyer' ELSE 'Supplier' END AS company_role,
               o.o_orderkey % 50 AS number_of_shipments, o.o_totalprice AS shipment_value, o.o_orderdate AS ingested_at
        FROM {orders} AS o JOIN {customer} AS c ON o.o_custkey = c.c_custkey JOIN {nation} AS n ON c.c_nationkey = n.n_nationkey""",
    "old_table": """
        SELECT CAST(c_custkey AS STRING) AS company_id, c_name AS name, c_acctbal AS balance, 'old' AS origin,
               TIMESTAMP '2023-01-01 00:00:00' AS created_on, 'job0' AS created_by,
               TIMESTAMP '2023-01-01 00:00:00' AS modified_on, 'job0' AS modified_by
        FROM {customer} WHERE c_nationkey < 15""",
    "new_table": """
        SELECT CAST(c_custkey AS STRING) AS company_id, upper(c_name) AS name, c_acctbal + 1 AS balance, 'new' AS origin,
               TIMESTAMP '2024-01-31 00:00:00' AS created_on, 'job1' AS created_by,
               TIMESTAMP '2024-01-31 00:00:00' AS modified_on, 'job1' AS modified_by
        FROM {customer} WHERE c_nationkey > 9""",
    "old_gold": """
        SELECT row_number() OVER (ORDER BY c_custkey) AS cp_key, CAST(c_custkey AS STRING) AS company_id, c_name AS name
        FROM {customer} WHERE c_nationkey < 10""",
    "gold_silver": "SELECT CAST(c_custkey AS STRING) AS company_id, lower(c_name) AS name FROM {customer} WHERE c_nationkey > 4",
    "tree_edges": """
        SELECT c_custkey + 1 AS node, CAST(floor((c_custkey + 1) / 6) AS BIGINT) AS parent, c_name AS name FROM {customer}""",
    "requests": """
        SELECT p_partkey AS id, p_name AS title, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS description,
               p_brand AS country, 'IMPORT' AS direction, p_size AS size FROM {part}""",
    "contact_scores": """
        SELECT c_custkey AS contact_id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 100 AS DOUBLE) END AS contact_accuracy_score
        FROM {customer}""",
    "enriched": "SELECT DISTINCT o_custkey AS contact_id FROM {orders} WHERE o_orderstatus = 'P'",
    "date_texts": """
        SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS STRING) WHEN 1 THEN 'n/a'
                 WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) ELSE NULL END AS raw FROM {orders}""",
    "pending_runs": """
        SELECT event_type AS feed_name, max(ts) AS run_at, count(*) AS records_loaded,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
               CASE WHEN event_type = 'error' THEN 'boom' ELSE NULL END AS error_msg FROM {events} WHERE event_type <> 'view' GROUP BY event_type""",
    "old_log": """
        SELECT event_type AS feed_name, min(ts) AS last_run_at, min(ts) AS last_success_at, CAST(1 AS BIGINT) AS records_loaded,
               'success' AS status, CAST(NULL AS STRING) AS error_msg FROM {events} WHERE event_type <> 'click' GROUP BY event_type""",
}
