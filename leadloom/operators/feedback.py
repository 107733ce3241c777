"""Seller feedback, conversions, demotion of stale leads, scores set by hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.config import Feedback, Scoring
from leadloom.functions.ids import stable_id
from leadloom.functions.rank import best_row, top_k
from leadloom.functions.values import as_ts, days_before, lookup, norm, whole_days

# Seller actions, and demotion rules (from, to, days without activity, new score).
ACTIONS = ["viewed", "contacted", "converted", "rejected", "archived"]
DEMOTION_RULES = [
    ("rfq_submitted", "rfq_draft", 7, 60),
    ("quote_ready", "rfq_submitted", 14, 75),
    ("hot_in_market", "known_account_interest", 3, 60),
    ("engaged_person", "known_person_interest", 21, 65),
    ("engaged_account", "known_account_interest", 30, 60),
    ("known_account_interest", "intent_only", 60, 50),
    ("known_person_interest", "intent_only", 60, 50),
    ("intent_only", "visit_only", 90, 35),
    ("trade_buyer_candidate", "intent_only", 45, 50),
    ("strategic_account_watch", "visit_only", 180, 30),
    ("reactivation_candidate", "intent_only", 30, 50),
    ("competitor_displacement", "known_account_interest", 30, 60),
    ("active_importer", "intent_only", 90, 50),
]
DEMOTED_VISIBILITY = {"rfq_draft": "push_notify", "rfq_submitted": "instant_alert", "known_account_interest": "feed",
                      "known_person_interest": "feed", "intent_only": "feed", "visit_only": "count_only"}


def valid_actions(actions: DataFrame) -> DataFrame:
    return actions.where(F.col("action").isin(*ACTIONS))


def feedback_rows(actions: DataFrame, assignments: DataFrame, leads: DataFrame) -> DataFrame:
    """One feedback row per assignment and action (the latest), with the lead's type and priority."""
    last = best_row(valid_actions(actions), ["assignment_id", "action"], [F.col("recorded_at")])
    return last.join(assignments.select("assignment_id", "seller_id", "lead_id"), "assignment_id").join(
        leads.select(F.col("lead_uid").alias("lead_id"), "lead_type", F.col("priority").alias("lead_priority")),
        "lead_id").select(
        F.concat(F.lit("fb:"), "assignment_id", F.lit(":"), "action").alias("feedback_id"), "assignment_id", "seller_id",
        "lead_id", "lead_type", "lead_priority", "action", "notes", "recorded_at")


def record_feedback(assignments: DataFrame, actions: DataFrame) -> DataFrame:
    """Assignments after the actions: the latest valid action is the status, empty notes keep the old ones."""
    last = best_row(valid_actions(actions).select("assignment_id", "recorded_at", "action", "notes"),
                    ["assignment_id"], [F.col("recorded_at")])
    joined = assignments.join(last.select("assignment_id", F.col("action").alias("_a"), F.col("notes").alias("_n"),
                                          F.col("recorded_at").alias("_t")), "assignment_id", "left")
    return joined.withColumns({
        "status": F.coalesce("_a", "status"), "actioned_at": F.coalesce("_t", "actioned_at"),
        "action_notes": F.coalesce(F.nullif("_n", F.lit("")), "action_notes")}).drop("_a", "_n", "_t")


def lead_feedback(leads: DataFrame, assignments: DataFrame, actions: DataFrame) -> DataFrame:
    """Leads with the latest valid seller action on any of their assignments."""
    acted = valid_actions(actions).join(assignments.select("assignment_id", "lead_id"), "assignment_id")
    last = best_row(acted.select("lead_id", "recorded_at", "action"), ["lead_id"], [F.col("recorded_at")])
    return leads.join(last.select(F.col("lead_id").alias("lead_uid"), F.col("action").alias("seller_feedback"),
                                  F.col("recorded_at").alias("seller_actioned_at")), "lead_uid", "left")


def feedback_rates(feedback: DataFrame, as_of, cfg: Feedback = Feedback()) -> DataFrame:
    """Per lead type over the last four tuning periods: counts by action, conversion and rejection rate."""
    since = days_before(as_ts(as_of), cfg.retune_every_days * 4)
    rows = feedback.where(F.col("recorded_at") >= since)
    return rows.groupBy("lead_type").agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("action") == a).alias(a) for a in ACTIONS]).withColumns({
            "conversion_rate": F.col("converted") / F.col("total"), "rejection_rate": F.col("rejected") / F.col("total")})


def tune_thresholds(rates: DataFrame, as_of, last_tuned=None, scoring: Scoring = Scoring(),
                    cfg: Feedback = Feedback()) -> DataFrame:
    """Threshold changes (setting, old_value, new_value) the feedback asks for; none before due or with few samples."""
    def rate(col: str, kind: str) -> Column:
        return F.max(F.when(F.col("lead_type") == kind, F.col(col)))
    seen = rates.agg(F.sum("total").alias("n"), rate("conversion_rate", "rfq_submitted").alias("rfq"),
                     rate("rejection_rate", "trade_buyer_candidate").alias("trade"),
                     rate("conversion_rate", "buying_committee_active").alias("maker"),
                     rate("rejection_rate", "warm_account").alias("warm"))
    due = F.lit(True) if last_tuned is None else whole_days(as_ts(as_of), as_ts(last_tuned)) >= cfg.retune_every_days
    s = scoring

    def change(name: str, old: int, new: Column) -> Column:
        return F.struct(F.lit(name).alias("setting"), F.lit(old).alias("old_value"), new.cast("int").alias("new_value"))
    moves = F.array(
        change("min_score_rfq", s.min_rfq, F.when(F.col("rfq") > 0.40, max(65, s.min_rfq - 2)).when(
            F.col("rfq") < 0.10, min(85, s.min_rfq + 2))),
        change("min_score_trade", s.min_trade, F.when(F.col("trade") > 0.60, min(55, s.min_trade + 2))),
        change("min_score_decision_maker", s.min_decision_maker, F.when(
            F.col("maker") > 0.30, max(45, s.min_decision_maker - 2))),
        change("seller_visible_evidence_min", s.visible_strength, F.when(
            F.col("warm") > 0.70, min(70, s.visible_strength + 5))))
    return seen.where(due & (F.col("n") >= cfg.min_samples)).select(F.explode(moves).alias("m")).select("m.*").where(
        "new_value is not null and new_value <> old_value")


def conversion_facts(assignments: DataFrame, leads: DataFrame, known: DataFrame) -> DataFrame:
    """A fact for every converted assignment without one; whole days to convert, never below 0."""
    fresh = assignments.where("status = 'converted'").join(known.select("assignment_id"), "assignment_id", "left_anti")
    rows = fresh.join(leads.withColumnRenamed("lead_uid", "lead_id").select(
        "lead_id", "lead_type", "hs_code", F.col("score_final").alias("final_score"),
        F.col("buyer_user_id").alias("buyer_key")), "lead_id")
    return rows.select(
        stable_id(F.col("assignment_id"), F.lit("conversion")).alias("conversion_id"), "assignment_id", "seller_id",
        "lead_id", "lead_type", "hs_code", "buyer_key", "final_score", F.lit(0.0).alias("deal_value"),
        F.greatest(F.lit(0), whole_days(F.col("actioned_at"), F.col("assigned_at"))).alias("days_to_convert"),
        F.col("actioned_at").alias("converted_at"))


def converted_leads(leads: DataFrame, facts: DataFrame) -> DataFrame:
    """Leads with status converted where a fact says so (the first conversion counts)."""
    first = facts.groupBy("lead_id").agg(F.min(F.struct("converted_at", "days_to_convert")).alias("c")).select(
        F.col("lead_id").alias("lead_uid"), F.col("c.converted_at").alias("converted_at"),
        F.col("c.days_to_convert").alias("days_to_convert"))
    return leads.join(first, "lead_uid", "left").withColumn(
        "status", F.when(F.col("converted_at").isNotNull(), "converted").otherwise(F.col("status")))


def link_conversion_buyers(facts: DataFrame, orgs: DataFrame) -> DataFrame:
    """conversion_id -> org_id where the buyer key is the organisation's id (else domain) or its name."""
    keyed = facts.where("buyer_key is not null").select("conversion_id", norm("buyer_key").alias("k"))
    ids = orgs.select(F.coalesce(norm("org_id"), norm("domain")).alias("k"), "org_id")
    names = orgs.select(norm("org_name").alias("k"), "org_id")
    return keyed.join(ids, "k").unionByName(keyed.join(names, "k")).where("k <> ''").select("conversion_id", "org_id").distinct()


def conversion_stats(facts: DataFrame) -> DataFrame:
    return facts.groupBy("lead_type").agg(F.count(F.lit(1)).alias("conversions"), F.avg("days_to_convert").alias("avg_days"),
                                          F.avg("final_score").alias("avg_score"))


def _rules(df: DataFrame) -> DataFrame:
    return F.broadcast(df.sparkSession.createDataFrame(
        DEMOTION_RULES, "lead_type string, to_type string, stale_days int, new_score int"))


def stale_leads(leads: DataFrame, as_of, cap: int | None = None) -> DataFrame:
    """Leads a demotion rule applies to, with the rule. A demotion stamps the time, so a lead meets one rule a run.

    ``cap``, if given, is the most per rule and run, longest untouched first; the rest follows next run.
    """
    now = as_ts(as_of)
    rows = leads.join(_rules(leads), "lead_type").where(
        ~F.coalesce("suppressed", F.lit(False)) & (F.coalesce("distribution_status", F.lit("")) != "suppressed"))
    limit = now - F.make_dt_interval(days=F.col("stale_days"))
    rows = rows.where((F.col("last_transition_at").isNull() | (F.col("last_transition_at") < limit))
                      & (F.col("classified_at").isNull() | (F.col("classified_at") < limit)))
    if cap is None:
        return rows
    touched = F.greatest("last_transition_at", "classified_at")
    return top_k(rows, ["lead_type"], [F.coalesce(touched, F.lit("1900-01-01").cast("timestamp")), F.col("lead_uid")], cap).drop("rank")


def demote_stale(leads: DataFrame, as_of, cap: int | None = None) -> DataFrame:
    """The lead table after one demotion run."""
    hit = stale_leads(leads, as_of, cap).select("lead_uid", "to_type", "new_score")
    joined = leads.join(hit, "lead_uid", "left")
    moved = F.col("to_type").isNotNull()
    return joined.withColumns({
        "previous_lead_type": F.when(moved, F.col("lead_type")),
        "lead_type": F.coalesce("to_type", "lead_type"),
        "score_final": F.coalesce("new_score", "score_final").cast("long"),
        "visibility_level": F.when(moved, lookup(DEMOTED_VISIBILITY, F.col("to_type"), "feed")).otherwise(
            F.col("visibility_level")),
        "last_transition_at": F.when(moved, as_ts(as_of)).otherwise(F.col("last_transition_at")),
        "transition_count": F.coalesce("transition_count", F.lit(0)) + moved.cast("int")}).drop("to_type", "new_score")


def state_history(leads: DataFrame, as_of, cap: int | None = None) -> DataFrame:
    """The history rows that demotion run appends."""
    now = F.date_format(as_ts(as_of), "yyyy-MM-dd'T'HH:mm:ss")
    return stale_leads(leads, as_of, cap).select(
        F.concat(F.lit("lsh:demotion:"), "lead_uid", F.lit(":"), now).alias("history_uid"), "lead_uid",
        F.col("lead_type").alias("state_from"), F.col("to_type").alias("state_to"),
        F.concat(F.lit("staleness_"), F.col("stale_days").cast("string"), F.lit("d")).alias("reason"),
        F.lit("demotion").alias("triggered_by"), F.col("new_score").alias("score_at_transition"),
        as_ts(as_of).alias("transitioned_at"))


def apply_overrides(rows: DataFrame, overrides: DataFrame, key: str, score: str) -> DataFrame:
    """Scores set by hand. The first one keeps the pipeline's score; a removal (null score) restores it.

    ``rows`` has <score>, <score>_original and score_override; ``overrides`` (key, new_score,
    reason, changed_by, changed_at): the latest per key counts.
    """
    last = best_row(overrides, [key], [F.col("changed_at")])
    joined = rows.join(last.select(key, F.col("new_score").alias("_s"), F.col("changed_at").alias("_t"),
                                   F.col("reason").alias("_r"), F.col("changed_by").alias("_b")), key, "left")
    touched, was_set = F.col("_t").isNotNull(), F.coalesce("score_override", F.lit(False))
    setting, removing = touched & F.col("_s").isNotNull(), touched & F.col("_s").isNull()
    original = f"{score}_original"
    return joined.withColumns({
        score: F.when(setting, F.col("_s")).when(removing, F.coalesce(original, score)).otherwise(F.col(score)),
        original: F.when(setting & ~was_set, F.col(score)).otherwise(F.col(original)),
        "score_override": F.when(touched, setting).otherwise(F.col("score_override")),
        "score_reason": F.when(setting, F.col("_r")), "score_changed_by": F.when(setting, F.col("_b")),
        "score_changed_at": F.when(setting, F.col("_t"))}).drop("_s", "_t", "_r", "_b")


def override_audit(**entities: tuple[DataFrame, str, str, str]) -> DataFrame:
    """All rows with a score set by hand over several entities: (frame, key, sub type, score column)."""
    out = None
    for label, (frame, key, sub_type, score) in entities.items():
        part = frame.where("score_override").select(
            F.lit(label).alias("node_type"), F.col(key).cast("string").alias("node_id"),
            F.col(sub_type).cast("string").alias("sub_type"), F.col(f"{score}_original").cast("double").alias("original_score"),
            F.col(score).cast("double").alias("current_score"), F.col("score_reason").alias("reason"),
            F.col("score_changed_by").alias("changed_by"), F.col("score_changed_at").alias("changed_at"))
        out = part if out is None else out.unionByName(part)
    return out.orderBy(F.desc("changed_at"), "node_type", "node_id")
