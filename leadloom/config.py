"""Typed settings. Every threshold an operator uses comes in through one of these."""

from __future__ import annotations

from dataclasses import dataclass, field


# Default thresholds, weights and limits of the lead factory, models and sellers.
@dataclass(frozen=True)
class Scoring:
    base_rfq: int = 70
    base_importer: int = 70
    base_commitment: int = 90
    base_decision_maker: int = 45
    base_default: int = 25
    bonus_product: int = 10
    bonus_person: int = 10
    bonus_combination: int = 10
    opp_weight_evidence: float = 0.40
    opp_weight_product: float = 0.30
    opp_weight_contact: float = 0.30
    opp_threshold: float = 0.65
    weak_identity_below: float = 0.55
    low_confidence_below: float = 0.50
    low_intent_below: int = 50
    no_fit_below: int = 40
    critical_score: int = 85
    high_score: int = 70
    visible_strength: int = 50
    window_rfq_days: int = 7
    window_trade_days: int = 90
    window_enrichment_days: int = 365
    window_behavior_days: int = 30
    weight_behavior: float = 0.15
    weight_intent: float = 0.25
    weight_trade: float = 0.25
    weight_fit: float = 0.15
    weight_recency: float = 0.10
    weight_reachability: float = 0.10
    min_rfq: int = 75
    min_decision_maker: int = 55
    min_trade: int = 40
    max_identity_miss_pct: float = 20.0
    max_evidence_null_pct: float = 5.0
    max_weak_leads_pct: float = 30.0
    decay_days: float = 30.0


@dataclass(frozen=True)
class Models:
    retrain_after_days: int = 30
    switch_lead_min_score: float = 60.0
    switch_prob_threshold: float = 0.40
    match_score_threshold: float = 60.0
    min_positives: int = 50
    min_pairs: int = 20
    contamination: float = 0.15
    seed: int = 42


@dataclass(frozen=True)
class Distribution:
    max_leads_per_day: int = 50
    switch_leads_per_lead: int = 3


@dataclass(frozen=True)
class Feedback:
    min_samples: int = 50
    retune_every_days: int = 7


@dataclass(frozen=True)
class SourcePrefixes:
    """Schema and table prefixes of the deployment; the signal map is written against these."""

    trade: str = "trade"
    firmo: str = "firmo"
    app: str = "app"


@dataclass(frozen=True)
class Settings:
    scoring: Scoring = field(default_factory=Scoring)
    models: Models = field(default_factory=Models)
    distribution: Distribution = field(default_factory=Distribution)
    feedback: Feedback = field(default_factory=Feedback)
    prefixes: SourcePrefixes = field(default_factory=SourcePrefixes)
    model_version: str = "v25_1_enterprise_modular_observed"


DEFAULT = Settings()
