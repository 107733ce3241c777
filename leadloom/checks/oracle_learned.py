"""DuckDB statements for the learned path: the same pieces as the rule-based one, with the models written out."""

from leadloom.checks.oracle_trade import TRADE
from leadloom.checks.sqltext import rnd, sid

MARGIN = """CASE WHEN last_shipment_date_days_ago <= 60 THEN CASE WHEN qty_trend_3m <= 0.6 THEN 0.4 ELSE -1.2 END
        ELSE CASE WHEN months_with_zero_shipments <= 4 THEN 0.3 ELSE 1.1 END END
    + CASE WHEN anomaly_score <= 0.35 THEN -0.5 WHEN qty_trend_3m > 0.9 THEN -0.1 WHEN last_shipment_date_days_ago <= 200 THEN 0.5 ELSE 0.9 END"""


def points(expr: str) -> str:
    return f"CAST(round({rnd(expr, 6)} * 1000000) AS BIGINT)"


def _renamed(piece: str, names: dict[str, str]) -> str:
    for old, new in names.items():
        piece = piece.replace("{" + old + "}", "{" + new + "}")
    return piece


CHAIN = {"health_status": "health_by_forest", "stress_reason": "stress_by_forest", "opps_model": "opps_by_forest",
         "switch_opportunities": "opportunities_by_forest", "relationship_features": "features_by_forest",
         "score_opportunities": "score_opportunities_by_model", "all_pairs": "pairs_by_model", "match_suppliers": "matches_by_model",
         "rule_matches": "rule_matches_by_model"}

LEARNED: dict[str, str] = {
    "anomaly_by_forest": """
        WITH z AS (SELECT *, (mean_qty - 60) / 40 AS z0, (cv_qty - 0.4) / 0.3 AS z1, slope / 2 AS z2, (zero_frac - 0.05) / 0.1 AS z3, (recent_vs_baseline - 1) / 0.5 AS z4 FROM {series_features}),
        p AS (SELECT *, pow(2.0, -((CASE WHEN z4 < -0.8 THEN 1.5 WHEN z1 < 0.9 THEN 4.2 ELSE 2.0 END)
                + (CASE WHEN z2 < -0.6 THEN 2.2 WHEN z0 >= 1.4 THEN 1.8 WHEN z3 < 0.7 THEN 5.0 ELSE 2.5 END)) / 2 / 3.0) AS raw FROM z)
        SELECT *, (raw - min(raw) OVER ()) / greatest(max(raw) OVER () - min(raw) OVER (), 1e-9) AS anomaly_score FROM p""",
    "health_by_forest": TRADE["health_status"].replace("{anomaly_statistical}", "{anomaly_by_forest}"),
    **{CHAIN[k]: _renamed(TRADE[k], CHAIN) for k in ("stress_reason", "opps_model", "switch_opportunities", "relationship_features", "all_pairs", "rule_matches")},
    "switch_probability_by_trees": f"""
        SELECT rel_id, m AS margin, 1 / (1 + exp(-m)) AS probability FROM (SELECT rel_id, CAST({MARGIN} AS DOUBLE) AS m FROM {{relationship_features}}) AS x""",
    "score_opportunities_by_model": f"""
        SELECT * EXCLUDE (status, p), CASE WHEN p >= 0.40 THEN {rnd('p', 4)} END AS switch_probability,
               CASE WHEN p >= 0.40 THEN status ELSE 'filtered_low_probability' END AS status
        FROM (SELECT o.*, 1 / (1 + exp(-m.m)) AS p FROM {{opportunities_by_forest}} AS o
              JOIN (SELECT rel_id, CAST({MARGIN} AS DOUBLE) AS m FROM {{features_by_forest}}) AS m ON o.rel_id = m.rel_id) AS x""",
    # Worth of every set of known features (a bit each), then the average of what a feature adds.
    "tree_contributions": """
        WITH s AS (SELECT CAST(range AS INTEGER) AS k FROM range(16)),
        w AS (SELECT rel_id, k, g1 * (g2 * 0.4 + (1 - g2) * -1.2) + (1 - g1) * (g3 * 0.3 + (1 - g3) * 1.1)
                + h1 * -0.5 + (1 - h1) * (h2 * (h3 * 0.5 + (1 - h3) * 0.9) + (1 - h2) * -0.1) AS v
              FROM (SELECT rel_id, k,
                  CASE WHEN k % 2 = 0 THEN 120 / 210.0::DOUBLE WHEN last_shipment_date_days_ago <= 60 THEN 1.0 ELSE 0.0 END AS g1,
                  CASE WHEN (k // 2) % 2 = 0 THEN 30 / 120.0::DOUBLE WHEN qty_trend_3m <= 0.6 THEN 1.0 ELSE 0.0 END AS g2,
                  CASE WHEN (k // 4) % 2 = 0 THEN 40 / 90.0::DOUBLE WHEN months_with_zero_shipments <= 4 THEN 1.0 ELSE 0.0 END AS g3,
                  CASE WHEN k // 8 = 0 THEN 100 / 210.0::DOUBLE WHEN anomaly_score <= 0.35 THEN 1.0 ELSE 0.0 END AS h1,
                  CASE WHEN (k // 2) % 2 = 0 THEN 70 / 110.0::DOUBLE WHEN qty_trend_3m <= 0.9 THEN 1.0 ELSE 0.0 END AS h2,
                  CASE WHEN k % 2 = 0 THEN 50 / 70.0::DOUBLE WHEN last_shipment_date_days_ago <= 200 THEN 1.0 ELSE 0.0 END AS h3
                FROM {relationship_features} CROSS JOIN s) AS g),
        f AS (SELECT CAST(range AS INTEGER) AS i, CAST(pow(2, range) AS INTEGER) AS b FROM range(4)),
        c AS (SELECT a.rel_id, f.i, sum((e.v - a.v) * CASE a.k % 2 + (a.k // 2) % 2 + (a.k // 4) % 2 + a.k // 8 WHEN 0 THEN 0.25::DOUBLE WHEN 3 THEN 0.25::DOUBLE ELSE 1 / 12.0::DOUBLE END) AS phi
              FROM w AS a JOIN f ON (a.k // f.b) % 2 = 0 JOIN w AS e ON e.rel_id = a.rel_id AND e.k = a.k + f.b GROUP BY a.rel_id, f.i)
        SELECT c.rel_id, min(w0.v) AS base, min(w15.v) AS margin, max(phi) FILTER (WHERE i = 0) AS by_last_shipment_date_days_ago,
               max(phi) FILTER (WHERE i = 1) AS by_qty_trend_3m, max(phi) FILTER (WHERE i = 2) AS by_months_with_zero_shipments, max(phi) FILTER (WHERE i = 3) AS by_anomaly_score
        FROM c JOIN w AS w0 ON w0.rel_id = c.rel_id AND w0.k = 0 JOIN w AS w15 ON w15.rel_id = c.rel_id AND w15.k = 15 GROUP BY c.rel_id""",
}


def _matches(pairs: str, opportunities: str) -> str:
    """Every candidate of every opportunity scored with the fixed weights."""
    own = "0.05 * p.active_buyer_count + 0.0002 * p.recent_export_volume + 0.001 * p.employee_count + 0.4 * p.has_contact - 0.003 * p.export_recency_days"
    ratio = "0.35 * greatest(0.0, least(10.0, coalesce(o.buyer_monthly_volume, 0) / CASE WHEN p.recent_export_volume = 0 THEN 1 ELSE p.recent_export_volume END))"
    return f"""
        WITH x AS (SELECT a.*, {points(own)} + {points(ratio)} + 1000000 + 2000000 * a.is_exact + 700000 * a.there AS raw
              FROM {{{pairs}}} AS a JOIN {{{opportunities}}} AS o ON a.opportunity_id = o.opportunity_id JOIN {{supplier_profile}} AS p ON a.supplier_id = p.supplier_id),
        y AS (SELECT *, CASE WHEN max(raw) OVER w = min(raw) OVER w THEN 50.0
                     ELSE CAST(raw - min(raw) OVER w AS DOUBLE) / (max(raw) OVER w - min(raw) OVER w) * 100 END AS s,
                     row_number() OVER (PARTITION BY opportunity_id ORDER BY raw DESC, supplier_id) AS rk FROM x WINDOW w AS (PARTITION BY opportunity_id))
        SELECT {sid("opportunity_id", "supplier_id")} AS match_id, opportunity_id, supplier_id AS candidate_supplier_id,
               supplier_name AS candidate_supplier_name, CASE WHEN is_exact = 1 THEN 'exact' ELSE 'chapter' END AS hs_code_match_type,
               {rnd('s', 1)} AS match_score, rk AS rank, active_buyer_count, there = 1 AS exports_to_buyer_country, has_contact > 0 AS has_contact
        FROM y WHERE rk <= 5 AND (rk = 1 OR s >= 60)"""


LEARNED |= {
    "match_suppliers_learned": _matches("all_pairs", "score_opportunities"),
    "matches_by_model": _matches("pairs_by_model", "score_opportunities_by_model"),
    "learned_leads": _renamed(TRADE["switch_leads_matched"], CHAIN),
    "learned_leads_unmatched": _renamed(TRADE["switch_leads_unmatched"], CHAIN),
}
