"""The lead factory: identity, evidence, opportunity, fit, class, lead, route, quality.

Every stage is one row per signal, so the stages are column steps (``with_identity`` ..
``with_lead``) on one wide frame: no join and no shuffle from signal to lead. The tables of the
stages are projections of it. Only identity resolution and the one-visible-lead-per-buyer rule
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.config import DEFAULT, Scoring
from leadloom.functions.values import as_ts, choose, norm, one_row, tidy_round, whole_days
from leadloom.operators.signals import CRM, ENRICH, THIRD, TRADE

# Signal types by meaning.
RFQ_TYPES = ["rfq_created", "rfq_submitted", "rfq_started", "inquiry_created", "specification_uploaded",
             "drawing_uploaded", "bom_uploaded", "boq_uploaded"]
RFQ_FIRST = ["rfq_submitted", "rfq_created", "rfq_started", "inquiry_created"]
DEAL_TYPES = ["deal_created", "deal_stage_progressed"]
COMMITMENT_TYPES = ["quote_sent", "quote_opened", "quote_accepted", "po_received", "contract_signed", "deal_won"]
ENRICHMENT_TYPES = ["contact_enriched", "firmographic_update_detected", "company_discovered"]
INTELLIGENCE_TYPES = ["meeting_scheduled", "contact_enriched", "third_party_intent_detected",
                      "business_event_detected", "news_trigger_detected"]
EVENT_TYPES = ["meeting_scheduled", "event_attended"]
OPEN_TYPES = ["lead_created", "deal_created", "deal_stage_progressed"]
EVIDENCE_CONFIDENCE = {TRADE: 0.90, ENRICH: 0.85, THIRD: 0.70, CRM: 0.85, "RFQInquirySource": 0.95}
HYPOTHESIS_OF = {
    "active_importer_detected": "new_sourcing_cycle",
    "rfq_intent_detected": "procurement_project_active",
    "decision_maker_presence_detected": "buying_committee_active",
    "procurement_commitment_detected": "strategic_consolidation",
    "active_opportunity_detected": "champion_reengagement",
}
CATEGORY_OF = {
    "active_importer_detected": "trade",
    "rfq_intent_detected": "intent",
    "decision_maker_presence_detected": "enrichment",
    "procurement_commitment_detected": "commitment",
}
LATE_STAGE = ["deal_ready", "quote_ready", "rfq_submitted", "strategic_consolidation"]
HIGH_TYPES = ["rfq_draft", "hot_in_market", "market_opportunity", "active_deal", "active_importer",
              "trade_buyer_candidate", "buying_committee_active"]
MEDIUM_TYPES = ["warm_account", "procurement_project_active", "strategic_account"]
LOW_TYPES = ["visit_only", "cold_market", "intent_only"]
VISIBILITY_GROUPS = [
    (["blocked"], "internal_only"),
    (["rfq_submitted", "deal_ready"], "instant_alert"),
    (["hot_in_market", "quote_ready", "buying_committee_active"], "push_notify"),
    (["market_opportunity", "strategic_account", "active_deal", "active_importer", "trade_buyer_candidate",
      "strategic_consolidation"], "priority"),
]
TAG_GROUPS = [
    (["rfq_submitted", "rfq_draft"], "inbound_rfq,respond_immediately"),
    (["active_importer", "trade_buyer_candidate"], "trade_data,proactive_outreach"),
    (["buying_committee_active", "strategic_account"], "contact_enrichment,multi_stakeholder"),
    (["strategic_consolidation"], "consolidation,executive_outreach"),
    (["deal_ready", "active_deal"], "late_stage,close_now"),
]
QUEUE_GROUPS = [
    (["rfq_submitted", "deal_ready", "strategic_consolidation"], "immediate"),
    (["rfq_draft", "hot_in_market", "active_importer", "buying_committee_active", "quote_ready"], "priority_queue"),
    (["trade_buyer_candidate", "market_opportunity", "procurement_project_active", "active_deal",
      "strategic_account"], "standard_queue"),
]
TEMPLATE_GROUPS = [
    (["rfq_submitted", "rfq_draft"], "rfq_alert_v25"),
    (["active_importer", "trade_buyer_candidate", "market_opportunity"], "trade_opportunity_v25"),
    (["deal_ready", "strategic_consolidation"], "deal_ready_v25"),
]


def _grouped(col: Column, groups, default: str) -> Column:
    return choose([(col.isin(*members), value) for members, value in groups], default)


def _trade_like(kind: Column, family: Column, words=("shipment", "import", "export")) -> Column:
    out = family == TRADE
    for word in words:
        out = out | F.contains(kind, F.lit(word))
    return out


def with_identity(signals: DataFrame, prefix: str = DEFAULT.prefixes.trade) -> DataFrame:
    """Who a signal is about: entity type and id, how it was found, how sure, and its priority."""
    account, person, domain = F.col("account_hint"), F.col("person_hint"), F.col("domain_hint")
    kind, family = F.col("signal_type"), F.col("source_family")
    has = [account.isNotNull(), person.isNotNull(), domain.isNotNull()]
    from_trade = has[0] & (family == TRADE)
    return signals.withColumns({
        "hypothesis_id": F.concat(F.lit("ih25:"), F.col("signal_uid")),
        "candidate_entity_type": choose([(has[0], "Account"), (has[1], "Person"), (has[2], "Organization")], "AnonymousSession"),
        "candidate_entity_id": F.coalesce(norm(account), norm(person), norm(domain), F.col("session_id").cast("string"),
                                          F.col("signal_uid")),
        "resolution_method": choose([
            (from_trade, f"{prefix}_company_id_or_account_hint"), (has[0], "exact_account_id_match"),
            (has[1], "exact_person_id_match"), (has[2], "email_domain_match")], "unresolved_signal"),
        "identity_confidence": choose([(from_trade, 0.95), (has[0], 0.78), (has[1], 0.80), (has[2], 0.70)], 0.40),
        "identity_status": F.when(has[0] | has[1] | has[2], "proposed").otherwise("poor_identity"),
        "processing_priority": choose([
            (kind.isin(*RFQ_FIRST), 100), (kind.isin(*DEAL_TYPES, *COMMITMENT_TYPES), 95), (_trade_like(kind, family), 90),
            (kind.isin(*INTELLIGENCE_TYPES), 80), (kind == "lead_created", 70)], 10)})


def identity_hypotheses(wide: DataFrame) -> DataFrame:
    """The identity table of a frame with identity columns."""
    return wide.select("hypothesis_id", "signal_uid", "signal_type", "candidate_entity_type", "candidate_entity_id",
                       "resolution_method", F.col("identity_confidence").alias("confidence_score"),
                       F.col("identity_status").alias("status"), "processing_priority")


def resolve_identity(hypotheses: DataFrame, accounts: DataFrame, persons: DataFrame) -> DataFrame:
    """Edges hypothesis -> account or person (frames with ``entity_id``) on the normalised id."""
    known = accounts.select(norm("entity_id").alias("_key"), F.lit("Account").alias("candidate_entity_type"),
                            F.col("entity_id").cast("string").alias("entity_id")).unionByName(
        persons.select(norm("entity_id").alias("_key"), F.lit("Person").alias("candidate_entity_type"),
                       F.col("entity_id").cast("string").alias("entity_id")))
    keyed = hypotheses.withColumn("_key", norm("candidate_entity_id"))
    return keyed.join(known, ["_key", "candidate_entity_type"]).select(
        "hypothesis_id", "candidate_entity_type", "entity_id",
        F.col("confidence_score").alias("resolution_confidence"))


def with_evidence(signals: DataFrame, as_of, cfg: Scoring = Scoring()) -> DataFrame:
    """Typed evidence of every signal still inside its time window, decayed by age; stale ones are dropped."""
    kind, family = F.col("signal_type"), F.col("source_family")
    when = F.coalesce(F.col("occurred_at").cast("timestamp"), as_ts(as_of))
    aged = signals.withColumn("signal_age_days", F.greatest(F.lit(0), whole_days(as_ts(as_of), when)))
    age = F.col("signal_age_days")
    window = choose([(kind.isin(*RFQ_TYPES), cfg.window_rfq_days), (_trade_like(kind, family), cfg.window_trade_days),
                     (kind.isin(*ENRICHMENT_TYPES), cfg.window_enrichment_days)], cfg.window_behavior_days)
    fresh = aged.where(age <= window).withColumn("evidence_type", choose([
        (kind.isin(*RFQ_TYPES), "rfq_intent_detected"),
        (_trade_like(kind, family, ("shipment", "import")), "active_importer_detected"),
        (kind.isin(*ENRICHMENT_TYPES), "decision_maker_presence_detected"),
        (kind.isin(*COMMITMENT_TYPES), "procurement_commitment_detected"),
        (kind.isin(*OPEN_TYPES), "active_opportunity_detected"),
        (kind.isin(*EVENT_TYPES), "event_engagement_detected")], "product_interest_cluster"))
    etype = F.col("evidence_type")
    is_rfq = etype == "rfq_intent_detected"
    product = F.col("product_hint").isNotNull() | F.col("hs_code").isNotNull()
    interest = product | F.col("category_hint").isNotNull()
    contact = F.col("person_hint").isNotNull() | F.col("email_hint").isNotNull() | F.col("phone_hint").isNotNull()
    base = choose([(is_rfq, cfg.base_rfq), (etype == "active_importer_detected", cfg.base_importer),
                   (etype == "procurement_commitment_detected", cfg.base_commitment),
                   (etype == "decision_maker_presence_detected", cfg.base_decision_maker)], cfg.base_default)
    context = F.when(interest, cfg.bonus_product).otherwise(0) + F.when(contact, cfg.bonus_person).otherwise(0)
    combo = F.when(((family == TRADE) & product) | is_rfq, cfg.bonus_combination).otherwise(0)
    decay = F.exp(-age.cast("double") / cfg.decay_days)
    staged = fresh.withColumns({
        "evidence_category": choose([(etype == k, v) for k, v in CATEGORY_OF.items()], "behavior"),
        "context_bonus": context, "combination_bonus": combo, "_decay": decay,
        "evidence_strength_raw": F.least(F.lit(100), base + context + combo)})
    return staged.withColumns({
        "evidence_uid": F.concat(F.lit("ev25:"), F.col("signal_uid")),
        "evidence_strength": F.greatest(F.lit(1), F.round(F.col("evidence_strength_raw") * F.col("_decay")).cast("long")),
        "decay_factor": F.round(F.col("_decay") * 1000) / 1000.0,
        "signal_confidence": choose([(family == f, c) for f, c in EVIDENCE_CONFIDENCE.items()],
                                    F.coalesce(F.col("confidence_score").cast("double"), F.lit(0.70))),
        "product_match": F.when(interest, 1.0).otherwise(0.3), "contact_exists": contact, "rfq_exists": is_rfq,
        "trade_exists": F.col("evidence_category") == "trade",
        "number_of_shipments": F.coalesce(F.col("number_of_shipments").cast("double"), F.lit(0.0))}).drop("_decay")


EVIDENCE_COLUMNS = ("evidence_uid", "signal_uid", "hypothesis_id", "evidence_type", "evidence_category", "context_bonus",
                    "combination_bonus", "evidence_strength_raw", "evidence_strength", "decay_factor", "signal_age_days",
                    "signal_confidence", "product_match", "contact_exists", "rfq_exists", "trade_exists", "number_of_shipments")


def evidence(wide: DataFrame) -> DataFrame:
    """The evidence table of a frame with identity and evidence columns."""
    return wide.select(*EVIDENCE_COLUMNS)


def opportunity_hypotheses(ev: DataFrame, cfg: Scoring = Scoring()) -> DataFrame:
    """What the buyer may be up to, by evidence type. The threshold is stored, not applied."""
    return ev.select(
        F.concat(F.lit("oh25:"), F.col("evidence_uid")).alias("hypothesis_id"), "evidence_uid",
        choose([(F.col("evidence_type") == k, v) for k, v in HYPOTHESIS_OF.items()],
               "high_intent_abandonment").alias("hypothesis_type"),
        F.concat(F.lit("v25_from_"), F.col("evidence_type")).alias("rule"), F.lit(cfg.opp_threshold).alias("threshold"),
        (cfg.opp_weight_evidence * (F.col("evidence_strength") / 100.0) + cfg.opp_weight_product * F.col("product_match")
         + cfg.opp_weight_contact * F.col("contact_exists").cast("double")).alias("confidence"))


def with_fit(wide: DataFrame, cfg: Scoring = Scoring()) -> DataFrame:
    """Six component scores, their weighted sum, what speaks against the lead, and the decision."""
    strength, cat = F.col("evidence_strength").cast("double"), F.col("evidence_category")
    rows = wide.withColumns({
        "behavior_score": F.when(cat == "behavior", strength).otherwise(0.0),
        "intent_score": F.when(cat == "intent", strength).otherwise(0.0),
        "trade_score": F.when(cat.isin("trade", "commitment"), strength).otherwise(0.0),
        "fit_score": F.col("product_match") * 100.0, "recency_score": F.col("decay_factor") * 100.0,
        "reachability_score": F.when(F.col("contact_exists"), 100.0).otherwise(25.0)})
    weights = {"behavior_score": cfg.weight_behavior, "intent_score": cfg.weight_intent,
               "trade_score": cfg.weight_trade, "fit_score": cfg.weight_fit, "recency_score": cfg.weight_recency,
               "reachability_score": cfg.weight_reachability}
    total = sum(w * F.col(c) for c, w in weights.items())
    rows = rows.withColumn("six_component_score", tidy_round(total, 0))
    score = F.col("six_component_score")
    rows = rows.withColumn("suppression_type", choose([
        (F.col("identity_confidence") < cfg.weak_identity_below, "weak_identity"),
        (F.col("signal_confidence") < cfg.low_confidence_below, "low_confidence"),
        (F.col("evidence_strength") < cfg.low_intent_below, "low_intent"),
        (score < cfg.no_fit_below, "no_fit")], None))
    against = F.col("suppression_type")
    return rows.withColumns({
        "fit_suppression_uid": F.concat(F.lit("fs25:"), F.col("evidence_uid")),
        "fit_band": choose([(score >= 85, "very_high_fit"), (score >= 70, "high_fit"), (score >= 50, "medium_fit")], "low_fit"),
        "final_decision": choose([(against == "weak_identity", "block"), (against.isNotNull(), "review"), (score >= 70, "allow"),
                                  (score >= 50, "review")], "block")})


FIT_COLUMNS = ("fit_suppression_uid", "evidence_uid", "behavior_score", "intent_score", "trade_score", "fit_score",
               "recency_score", "reachability_score", "six_component_score", "fit_band", "suppression_type", "final_decision")


def fit_scores(wide: DataFrame) -> DataFrame:
    """The fit table of a frame with identity, evidence and fit columns."""
    return wide.select(*FIT_COLUMNS)


def with_class(wide: DataFrame, cfg: Scoring = Scoring()) -> DataFrame:
    """Lead type by the first of 20 ordered rules, then grain, stage, priority and visibility."""
    s, t = F.col("six_component_score"), F.col("evidence_type")
    high, critical, repeat = s >= cfg.high_score, s >= cfg.critical_score, F.col("number_of_shipments") >= 5
    trade = F.col("evidence_category") == "trade"
    rfq, commit = t == "rfq_intent_detected", t == "procurement_commitment_detected"
    active, maker = t == "active_opportunity_detected", t == "decision_maker_presence_detected"
    event = t == "event_engagement_detected"
    rows = wide.withColumn("lead_type", choose([
        (F.col("final_decision") == "block", "blocked"),
        (rfq & (s >= cfg.min_rfq), "rfq_submitted"), (rfq, "rfq_draft"),
        (commit & repeat, "strategic_consolidation"), (commit, "deal_ready"),
        (active & high, "active_deal"), (active, "procurement_project_active"),
        (trade & repeat & high, "active_importer"), (trade & high, "trade_buyer_candidate"),
        (trade & (s >= cfg.min_trade), "market_opportunity"), (trade, "cold_market"),
        (maker & (s >= cfg.min_decision_maker), "buying_committee_active"), (maker, "strategic_account"),
        (event & critical, "quote_ready"), (event & high, "hot_in_market"),
        (critical, "procurement_project_active"), (high, "hot_in_market"),
        (s >= 50, "warm_account"), (s >= 30, "intent_only")], "visit_only"))
    lt = F.col("lead_type")
    return rows.withColumns({
        "classification_uid": F.concat(F.lit("lc25:"), F.col("fit_suppression_uid")),
        "lead_grain": choose([
            (lt == "blocked", "none"),
            (F.col("rfq_exists") | F.col("trade_exists") | (F.col("product_match") >= 0.60), "opportunity_lead"),
            (F.col("contact_exists"), "person_lead")], "account_lead"),
        "lead_stage": choose([(lt.isin(*LATE_STAGE), "late"), (lt == "blocked", "invalid"),
                              (lt.isin("visit_only", "cold_market"), "early")], "mid"),
        "priority": choose([(lt.isin(*LATE_STAGE) | critical, "critical"), (lt.isin(*HIGH_TYPES) | high, "high"),
                            (lt.isin(*MEDIUM_TYPES), "medium"), (lt.isin(*LOW_TYPES), "low"), (lt == "blocked", "none")], "medium"),
        "visibility": _grouped(lt, VISIBILITY_GROUPS, "feed")})


CLASS_COLUMNS = ("classification_uid", "fit_suppression_uid", "evidence_uid", "lead_type", "lead_grain", "lead_stage",
                 "priority", "visibility")


def classify_leads(wide: DataFrame) -> DataFrame:
    """The classification table of a frame with all columns up to the class."""
    return wide.select(*CLASS_COLUMNS)


def create_leads(wide: DataFrame, cfg: Scoring = Scoring(), prefix: str = DEFAULT.prefixes.trade) -> DataFrame:
    """Leads of everything not blocked; only strong, allowed ones are visible to sellers."""
    rows = wide.where(F.col("lead_type") != "blocked")
    lt, method = F.col("lead_type"), F.col("resolution_method")
    shown = (F.col("evidence_strength") >= cfg.visible_strength) & (F.col("final_decision") == "allow")
    return rows.select(
        F.concat(F.lit("lead25:"), F.col("classification_uid")).alias("lead_uid"), "classification_uid",
        "lead_grain", "lead_type", "lead_stage", "priority",
        F.when(shown, F.col("visibility")).otherwise("internal_only").alias("visibility"),
        shown.alias("seller_visible"), shown.alias("routing_eligible"), "final_decision",
        F.col("six_component_score").alias("final_score"), "evidence_strength", "decay_factor", "signal_age_days",
        "identity_confidence",
        F.col("candidate_entity_id").alias("buyer_account_key"),
        choose([(F.contains(method, F.lit(prefix)), "known_trade_account"),
                (F.contains(method, F.lit("crm")) | F.contains(method, F.lit("account")), "known_crm_account"),
                (F.col("identity_status") == "poor_identity", "unresolved_account")],
               "candidate_account").alias("account_state"),
        _grouped(lt, TAG_GROUPS, "standard_outreach").alias("playbook_tags"),
        choose([(F.col("rfq_exists"), "specific_product_rfq"),
                (F.col("trade_exists") & (F.col("number_of_shipments") > 0), "repeat_importer"),
                (F.col("trade_exists"), "trade_signal"), (F.col("contact_exists"), "known_contact")],
               "broad_interest").alias("opportunity_specificity"),
        F.when(shown, "new").otherwise("internal_candidate").alias("status"))


def dedup_leads(leads: DataFrame) -> DataFrame:
    """Per buyer only the best visible lead stays visible (highest score, then smallest lead_uid).

    The best lead is found by an aggregate, so a buyer with a third of all leads does not end in
    one window task, and marked by a join on the evenly spread lead_uid.
    """
    best = leads.where(F.col("seller_visible") & F.col("buyer_account_key").isNotNull()).groupBy(
        "buyer_account_key").agg(F.min(F.struct((-F.col("final_score")).alias("s"), "lead_uid")).alias("b")).select(
        F.col("b.lead_uid").alias("lead_uid"), F.lit(True).alias("_best"))
    rows = leads.join(best, "lead_uid", "left").withColumn("dedup_suppressed", F.col("seller_visible") & F.col(
        "buyer_account_key").isNotNull() & F.col("_best").isNull())
    hide = F.col("dedup_suppressed")
    return rows.withColumns({
        "seller_visible": F.col("seller_visible") & ~hide, "routing_eligible": F.col("routing_eligible") & ~hide,
        "visibility": F.when(hide, "internal_only").otherwise(F.col("visibility"))}).drop("_best")


def route_leads(leads: DataFrame) -> DataFrame:
    """Queue, notification, first history entry and pending outcome of every lead that may be routed.

    One row per lead; ``notifications_of``, ``history_of`` and ``outcomes_of`` are its projections.
    """
    lt = F.col("lead_type")
    rows = leads.where(F.col("routing_eligible")).withColumn("routing_queue", _grouped(lt, QUEUE_GROUPS, "research_queue"))
    push = (F.col("routing_queue") == "immediate") | F.col("visibility").isin("instant_alert", "push_notify") | F.col(
        "priority").isin("critical", "high")
    return rows.select(
        "lead_uid", "lead_type", "routing_queue",
        F.concat(F.lit("queue:"), F.replace("routing_queue", F.lit("_queue"), F.lit(""))).alias("queue_id"),
        F.lit("seller:default_unassigned").alias("seller_id"),
        F.concat(F.lit("notify:v25:"), F.col("lead_uid")).alias("notification_id"),
        F.when(push, "push").otherwise("in_app").alias("channel"),
        _grouped(lt, TEMPLATE_GROUPS, "lead_alert_v25").alias("template"), F.col("priority").alias("urgency"),
        F.concat(F.lit("status:v25:"), F.col("lead_uid")).alias("history_id"),
        F.concat(F.lit("outcome:pending:v25:"), F.col("lead_uid")).alias("outcome_id"))


def notifications_of(routed: DataFrame) -> DataFrame:
    return routed.select("notification_id", "lead_uid", "channel", "template", "urgency", "routing_queue")


def history_of(routed: DataFrame) -> DataFrame:
    return routed.select("history_id", "lead_uid", F.lit("new").alias("status_sequence"),
                         F.lit("created_by_v25_2_factory_6component").alias("transition_reasons"), "routing_queue")


def outcomes_of(routed: DataFrame) -> DataFrame:
    return routed.select("outcome_id", "lead_uid", F.lit("pending").alias("outcome_type"), F.lit(0).alias("value"))


def pipeline_quality(signals: DataFrame, hypotheses: DataFrame, ev: DataFrame, classes: DataFrame,
                     leads: DataFrame, cfg: Scoring = Scoring()) -> DataFrame:
    """One row: integrity counts, three percentages against their limits, messages and the verdict."""
    with_id = signals.select("signal_uid").join(hypotheses.select("signal_uid"), "signal_uid", "left_semi")
    counts = [
        signals.agg(F.count(F.lit(1)).alias("total_signals")),
        with_id.agg(F.count(F.lit(1)).alias("signals_with_identity")),
        hypotheses.join(signals.select("signal_uid"), "signal_uid", "left_anti").agg(
            F.count(F.lit(1)).alias("orphaned_identity_hypotheses")),
        ev.agg(F.count(F.lit(1)).alias("total_evidence"),
               F.count_if(F.col("evidence_strength").isNull()).alias("evidence_missing_strength"),
               F.count_if(~F.col("evidence_strength").between(0, 100)).alias("evidence_invalid_strength")),
        ev.join(hypotheses.select("hypothesis_id"), "hypothesis_id", "left_anti").agg(
            F.count(F.lit(1)).alias("evidence_without_identity")),
        leads.agg(F.count(F.lit(1)).alias("total_leads"), F.count_if(
            F.coalesce("evidence_strength", F.lit(0)) < cfg.visible_strength).alias("weak_leads")),
        leads.join(classes.select("classification_uid"), "classification_uid", "left_anti").agg(
            F.count(F.lit(1)).alias("leads_without_classification")),
    ]
    row = one_row(counts).withColumn("signals_without_identity", F.col("total_signals") - F.col("signals_with_identity"))

    def pct(part: str, whole: str) -> Column:
        return F.col(part) * 100.0 / F.greatest(F.col(whole), F.lit(1))

    row = row.withColumns({"identity_miss_pct": pct("signals_without_identity", "total_signals"),
                           "evidence_null_pct": pct("evidence_missing_strength", "total_evidence"),
                           "weak_leads_pct": pct("weak_leads", "total_leads")})
    checks = [(F.col("identity_miss_pct") > cfg.max_identity_miss_pct, "signals without identity"),
              (F.col("evidence_null_pct") > cfg.max_evidence_null_pct, "evidence without strength"),
              (F.col("weak_leads_pct") > cfg.max_weak_leads_pct, "weak leads"),
              (F.col("evidence_invalid_strength") > 0, "invalid strength"),
              (F.col("leads_without_classification") > 0, "leads without classification")]
    failed = F.filter(F.array(*[F.when(c, F.lit(m)) for c, m in checks]), lambda x: x.isNotNull())
    row = row.withColumn("_f", failed)
    return row.select(
        "total_signals", "signals_without_identity", "signals_with_identity", "evidence_missing_strength",
        "evidence_invalid_strength", "leads_without_classification", "weak_leads", "total_leads",
        "orphaned_identity_hypotheses", "evidence_without_identity",
        *[tidy_round(F.col(c), 2).alias(c) for c in ("identity_miss_pct", "evidence_null_pct", "weak_leads_pct")],
        F.size("_f").alias("failures"),
        F.when(F.size("_f") > 0, F.array_join("_f", " | ")).otherwise("all_passed").alias("failure_messages"),
        (F.size("_f") == 0).alias("passed"))
