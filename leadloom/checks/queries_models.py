"""Registered queries: models and their measures."""

from pyspark.sql import functions as F

from leadloom.checks.fixtures import AS_OF_EVENTS
from leadloom.checks.queries_trade import plan
from leadloom.checks.registry import Registry
from leadloom.operators import health as h
from leadloom.operators import models as m
from leadloom.session import staged

RANK_FEATURES = ("f1", "f2", "f3")


def forest(i):
    return m.anomaly_forest(h.series_features(plan(i).snapshots))


def trained(i, trees: int = 200, boosted: bool = True, depth: int = 6):
    t = plan(i)
    rows = staged(m.training_rows(t.features, t.rules.select(
        "rel_id", F.col("rule_status").alias("health_status"), F.lit(0.0).alias("anomaly_score"))), "training")
    return m.fit_switch_classifier(rows, trees=trees, depth=depth, boosted=boosted), rows


def classified(i):
    model, rows = trained(i)
    return m.switch_probability(model, rows)


def explained(i):
    model, rows = trained(i, 5, depth=4)
    return m.score_explanations(model, rows, top=5)


def ranked(i):
    rows = i.won_lost
    weights = m.fit_pairwise_ranker(rows, "opportunity_id", "won", RANK_FEATURES)
    return m.rank_pairwise(rows, "opportunity_id", "candidate", RANK_FEATURES, weights)


def register(r: Registry) -> None:
    add = r.add
    add("anomaly_forest", forest, "rel_id,anomaly_score:d", None)
    add("switch_classifier", classified, "rel_id,probability:d", None)
    add("pairwise_ranker", ranked, "opportunity_id,candidate:i,rank_score:d,rank:i", None)
    add("score_explanations", explained, "rel_id,feature,contribution:d,rank:i", None)
    add("classifier_metrics", lambda i: m.classifier_metrics(i.scored_labels),
        "tp:i,fp:i,tn:i,fn:i,accuracy:d,precision:d,recall:d,f1:d,roc_auc:d")
    add("ranker_metrics", lambda i: m.ranker_metrics(i.ranked_lists, "q", "score", "label", "item"),
        "mean_reciprocal_rank:d,ndcg_at_5:d,n_queries:i")
    add("model_freshness", lambda i: m.model_freshness(i.model_runs, AS_OF_EVENTS), "models_present:i,oldest_age_days:i,fresh")
