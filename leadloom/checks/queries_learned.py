"""Registered queries: the learned path with fixed models, whose SQL has its own copy of them, and with trained ones."""

import uuid

from leadloom.checks.fixtures import AS_OF_TRADE
from leadloom.checks.queries_models import trained
from leadloom.checks.queries_trade import HEALTH, LEAD, OPP, plan
from leadloom.checks.registry import Registry
from leadloom.operators import models, ranking
from leadloom.operators.forests import Forest, Tree, feature_importances, forest_contributions, forest_scores
from leadloom.operators.model_store import ModelStore
from leadloom.plans.learned import LearnedTradePlan, importances
from leadloom.session import shared_dir

# Small models for the checks.
DETECTOR = {"columns": ["mean_qty", "cv_qty", "slope", "zero_frac", "recent_vs_baseline"], "mean": [60.0, 0.4, 0.0, 0.05, 1.0],
            "deviation": [40.0, 0.3, 2.0, 0.1, 0.5], "typical": 3.0,
            "trees": [[4, -0.8, 1.5, [1, 0.9, 4.2, 2.0]], [2, -0.6, 2.2, [0, 1.4, [3, 0.7, 5.0, 2.5], 1.8]]]}
CLASSIFIER = Forest(
    ("last_shipment_date_days_ago", "qty_trend_3m", "months_with_zero_shipments", "anomaly_score"),
    (Tree((0, 1, 2, -1, -1, -1, -1), (60.0, 0.6, 4.0, 0.0, 0.0, 0.0, 0.0), (1, 3, 5, -1, -1, -1, -1), (2, 4, 6, -1, -1, -1, -1),
          (0.0, 0.0, 0.0, 0.4, -1.2, 0.3, 1.1), (210.0, 120.0, 90.0, 30.0, 90.0, 40.0, 50.0)),
     Tree((3, -1, 1, 0, -1, -1, -1), (0.35, 0.0, 0.9, 200.0, 0.0, 0.0, 0.0), (1, -1, 3, 5, -1, -1, -1), (2, -1, 4, 6, -1, -1, -1),
          (0.0, -0.5, 0.0, 0.0, -0.1, 0.5, 0.9), (210.0, 100.0, 110.0, 70.0, 40.0, 50.0, 20.0))))
WEIGHTS = {"hs_exact_match": 2.0, "hs_chapter_match": 1.0, "active_buyer_count": 0.05, "recent_export_volume": 0.0002, "exports_to_buyer_country": 0.7,
           "employee_count": 0.001, "has_contact": 0.4, "export_recency_days": -0.003, "buyer_volume_ratio": 0.35}


def learned(i) -> LearnedTradePlan:
    """The plan with the fixed models, published to a store of its own and read back."""
    if "learned_plan" not in i.__dict__:
        store = ModelStore(i.spark, f"{shared_dir(i.spark).rstrip('/')}/store/{uuid.uuid4().hex}")
        store.publish("health_detector", DETECTOR, AS_OF_TRADE)
        store.publish("switch_classifier", CLASSIFIER, AS_OF_TRADE)
        store.publish("supplier_ranker", {"weights": WEIGHTS}, AS_OF_TRADE)
        i.learned_plan = LearnedTradePlan(i, AS_OF_TRADE, store)
    return i.learned_plan


def contributions(i):
    rows = forest_contributions(CLASSIFIER, plan(i).features)
    return rows.selectExpr("rel_id", "base", "margin", *[f"contributions[{n}] AS by_{f}" for n, f in enumerate(CLASSIFIER.features)])


def trained_importances(i):
    """What the training run keeps with the classifier, read from the store."""
    model, _ = trained(i, 10, boosted=False, depth=4)
    store = ModelStore(i.spark, f"{shared_dir(i.spark).rstrip('/')}/store/{uuid.uuid4().hex}")
    if model is not None:  # too few positive rows to train on
        store.publish("switch_classifier", model, AS_OF_TRADE, {"importances": dict(feature_importances(model))})
    return importances(store)


def forest_fallback(i):
    model, rows = trained(i, 10, boosted=False, depth=4)
    return models.switch_probability(model, rows)


def register(r: Registry) -> None:
    add = r.add
    add("health_by_forest", lambda i: learned(i).health, HEALTH)
    add("switch_probability_by_trees", lambda i: forest_scores(CLASSIFIER, plan(i).features), "rel_id,margin:d,probability:d")
    add("tree_contributions", contributions, "rel_id,base:d,margin:d,by_last_shipment_date_days_ago:d,by_qty_trend_3m:d,by_months_with_zero_shipments:d,by_anomaly_score:d")
    add("score_opportunities_by_model", lambda i: learned(i).scored, OPP + ",switch_probability:d")
    add("match_suppliers_learned", lambda i: ranking.match_suppliers_learned(
        plan(i).scored, plan(i).candidates, plan(i).rels, i.buyer_countries, WEIGHTS),
        "match_id,opportunity_id,candidate_supplier_id,candidate_supplier_name,hs_code_match_type,match_score:d,rank:i,active_buyer_count:i,exports_to_buyer_country,has_contact")
    add("learned_leads", lambda i: learned(i).matched_leads, LEAD)
    add("learned_leads_unmatched", lambda i: learned(i).unmatched_leads, LEAD)
    add("switch_classifier_forest", forest_fallback, "rel_id,probability:d", None)
    add("feature_importances", trained_importances, "feature,importance:d,rank:i", None)
