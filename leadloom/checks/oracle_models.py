"""Fixtures and DuckDB statements for models and their measures."""

from leadloom.checks.sqltext import rnd

MODEL_FIXTURES: dict[str, str] = {
    "scored_labels": "SELECT event_id, CASE WHEN value > 8 THEN 1 ELSE 0 END AS label, CAST((event_id * 37 + user_id * 11) % 997 AS DOUBLE) / 1000 AS probability FROM {events}",
    "ranked_lists": "SELECT l_orderkey AS q, l_linenumber * 100000 + l_partkey AS item, l_quantity AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM {lineitem}",
    "won_lost": "SELECT l_orderkey AS opportunity_id, l_linenumber * 100000 + l_partkey AS candidate, l_quantity AS f1, l_discount AS f2, l_tax AS f3, CASE WHEN l_quantity * (1 - l_discount) > 30 THEN 1 ELSE 0 END AS won FROM {lineitem}",
    "model_runs": "SELECT CASE event_id % 4 WHEN 0 THEN 'health_detector' WHEN 1 THEN 'switch_classifier' WHEN 2 THEN 'supplier_ranker' ELSE 'old' END AS model, ts AS trained_at FROM {events} WHERE ts < TIMESTAMP '2024-01-20 00:00:00'",
}

MODELS: dict[str, str] = {
    "classifier_metrics": f"""
        WITH c AS (SELECT count(*) FILTER (WHERE label = 1 AND probability >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND probability >= 0.5) AS fp, count(*) FILTER (WHERE label = 0 AND probability < 0.5) AS tn,
                count(*) FILTER (WHERE label = 1 AND probability < 0.5) AS fn FROM {{scored_labels}}),
        r AS (SELECT label, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS k FROM {{scored_labels}}),
        a AS (SELECT (sum(k) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0) / (count(*) FILTER (WHERE label = 1) * CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE)) AS auc FROM r)
        SELECT tp, fp, tn, fn, {rnd('(tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE)', 4)} AS accuracy, {rnd('tp / CAST(tp + fp AS DOUBLE)', 4)} AS precision, {rnd('tp / CAST(tp + fn AS DOUBLE)', 4)} AS recall,
               {rnd('2.0 * tp / (2 * tp + fp + fn)', 4)} AS f1, {rnd('auc', 4)} AS roc_auc FROM c, a""",
    "ranker_metrics": f"""
        WITH r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, item) AS r, row_number() OVER (PARTITION BY q ORDER BY label DESC, item) AS i FROM {{ranked_lists}}),
        p AS (SELECT q, min(r) FILTER (WHERE label = 1) AS f, sum(label / log2(r + 1)) FILTER (WHERE r <= 5) AS d, sum(label / log2(i + 1)) FILTER (WHERE i <= 5) AS g FROM r GROUP BY q)
        SELECT {rnd('avg(1.0 / f)', 4)} AS mean_reciprocal_rank, {rnd('avg(CASE WHEN g > 0 THEN d / g ELSE 0 END)', 4)} AS ndcg_at_5, count(*) AS n_queries FROM p""",
    "model_freshness": """
        SELECT count(*) AS models_present, CAST(floor((epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(min(t))) / 86400) AS BIGINT) AS oldest_age_days, count(*) = 3 AND epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(min(t)) < 30 * 86400 AS fresh
        FROM (SELECT model, max(trained_at) AS t FROM {model_runs} WHERE model <> 'old' GROUP BY model) AS x""",
}
