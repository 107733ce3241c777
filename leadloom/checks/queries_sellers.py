"""Registered queries: sellers and feedback."""

from pyspark.sql import functions as F

from leadloom.checks.fixtures import AS_OF_EVENTS
from leadloom.checks.registry import Registry
from leadloom.operators import feedback as f
from leadloom.operators import sellers as s

ASSIGN = "assignment_id,seller_id,lead_id,priority,match_reason,credits_cost:i"


def stats(i):
    return s.seller_stats(i.sellers, i.assignments, i.conversions)


def facts(i):
    return f.conversion_facts(i.assignments, i.leads, i.old_facts)


def overridden(i):
    return f.apply_overrides(i.overridable, i.overrides, "lead_uid", "score_final")


def audited(i):
    """Four kinds of nodes with scores set by hand."""
    def kind(name: str):
        return i.overridden_nodes.where(F.col("kind") == name).selectExpr(
            "key", "sub", "original AS score_original", "score", "hand AS score_override", "reason AS score_reason", "changed_by AS score_changed_by", "changed_at AS score_changed_at")
    others = {n: (kind(n), "key", "sub", "score") for n in ("BuyerProfile", "TradeRelationship", "SwitchLead")}
    return f.override_audit(Lead=(overridden(i), "lead_uid", "lead_type", "score_final"), **others)


def register(r: Registry) -> None:
    add = r.add
    add("seller_stats", stats, "seller_id,total_assigned:i,total_converted:i,win_rate:d,avg_response_h:d")
    add("rank_sellers", lambda i: s.rank_sellers(i.market_leads, i.sellers, stats(i)),
        "hs_chapter,country,visibility,seller_id,rank_score:d,rank:i")
    add("pending_leads", lambda i: s.pending_leads(i.distribution_leads, i.assignments.where("status = 'converted'")), "lead_id,lead_type,distribution_status")
    add("mark_distributed", lambda i: s.mark_distributed(i.distribution_leads, i.assignments.where("status = 'assigned'"), AS_OF_EVENTS),
        "lead_id,distribution_status,distributed_at")
    add("assign_leads", lambda i: s.assign_leads(i.market_leads, i.sellers), ASSIGN)
    add("assign_exclusive", lambda i: s.assign_exclusive(i.market_leads, i.sellers, stats(i)), ASSIGN, None)
    add("assign_switch_leads", lambda i: s.assign_switch_leads(i.market_leads, i.sellers), ASSIGN, None)
    add("reset_daily_counts", lambda i: s.reset_daily_counts(i.sellers, AS_OF_EVENTS), "seller_id,leads_today:i,leads_today_date:s")
    add("upsert_sellers", lambda i: s.upsert_sellers(i.sellers, i.given_sellers),
        "seller_id,name,tier,max_leads_per_day:i,credits_available:d,active")
    add("credit_ledger", lambda i: s.credit_ledger(i.accounts, i.transactions),
        "seller_id,credits_available:d,credits_used:d,refused:i")
    add("billing_reset", lambda i: s.billing_reset(i.accounts, AS_OF_EVENTS),
        "seller_id,credits_used_month:d,credits_available:d,billing_cycle_start:s")
    add("tier_access", lambda i: s.tier_access(i.assignments.select("assignment_id", "seller_id", "lead_id").join(
        i.leads.select(F.col("lead_uid").alias("lead_id"), "priority"), "lead_id"), i.sellers), "assignment_id,tier,priority,accessible")
    add("record_feedback", lambda i: f.record_feedback(i.assignments, i.actions), "assignment_id,status,actioned_at,action_notes")
    add("feedback_rows", lambda i: f.feedback_rows(i.actions, i.assignments, i.leads),
        "feedback_id,assignment_id,seller_id,lead_id,lead_type,lead_priority,action,notes,recorded_at")
    add("lead_feedback", lambda i: f.lead_feedback(i.leads, i.assignments, i.actions), "lead_uid,seller_feedback,seller_actioned_at")
    add("feedback_rates", lambda i: f.feedback_rates(i.feedback_log, AS_OF_EVENTS),
        "lead_type,total:i,converted:i,rejected:i,viewed:i,conversion_rate:d,rejection_rate:d")
    add("tune_thresholds", lambda i: f.tune_thresholds(f.feedback_rates(i.feedback_log, AS_OF_EVENTS), AS_OF_EVENTS),
        "setting,old_value:i,new_value:i")
    add("conversion_facts", facts,
        "conversion_id,assignment_id,seller_id,lead_id,lead_type,hs_code,buyer_key,final_score:i,deal_value:d,days_to_convert:i,converted_at")
    add("converted_leads", lambda i: f.converted_leads(i.leads.withColumn("status", F.lit("new")), facts(i)), "lead_uid,status,converted_at")
    add("link_conversion_buyers", lambda i: f.link_conversion_buyers(facts(i).withColumn(
        "buyer_key", F.concat(F.lit("c"), "buyer_key")), i.orgs), "conversion_id,org_id")
    add("conversion_stats", lambda i: f.conversion_stats(facts(i)), "lead_type,conversions:i,avg_days:d,avg_score:d")
    add("demote_stale", lambda i: f.demote_stale(i.leads, AS_OF_EVENTS),
        "lead_uid,lead_type,score_final:i,visibility_level,previous_lead_type,last_transition_at,transition_count:i")
    add("state_history", lambda i: f.state_history(i.leads, AS_OF_EVENTS),
        "history_uid,lead_uid,state_from,state_to,reason,triggered_by,score_at_transition:i,transitioned_at")
    add("apply_overrides", overridden,
        "lead_uid,lead_type,score_final:i,score_final_original:s,score_override,score_reason,score_changed_by,score_changed_at")
    add("override_audit", audited, "node_type,node_id,sub_type,original_score:d,current_score:d,reason,changed_by,changed_at")
