"""Registered queries: signals and the lead factory."""

from leadloom.checks.fixtures import AS_OF_EVENTS
from leadloom.checks.registry import Registry
from leadloom.config import Scoring, SourcePrefixes
from leadloom.operators import factory as f
from leadloom.operators import signals as s
from leadloom.plans.factory import FactoryPlan

LEAD = "lead_uid,classification_uid,lead_grain,lead_type,lead_stage,priority,visibility,seller_visible,routing_eligible,final_decision,final_score:d,evidence_strength:i,decay_factor:d,signal_age_days:i,identity_confidence:d,buyer_account_key,account_state,playbook_tags,opportunity_specificity,status"


def plan(i) -> FactoryPlan:
    return FactoryPlan(i.signals, AS_OF_EVENTS)


def tuned(i) -> FactoryPlan:
    """With the default weights no single signal reaches the 'allow' score; these let some through."""
    return FactoryPlan(i.signals, AS_OF_EVENTS, Scoring(weight_intent=0.6, weight_trade=0.6))


def register(r: Registry) -> None:
    r.add("signal_type_of", lambda i: s.signal_type_of(i.source_keys), "source_key,event_id,signal_type,source_family")
    r.add("normalise_signals", lambda i: s.normalise_signals(
        i.shipment_rows, "raw.trade_shipment_bl", "shipment_detected", s.TRADE, AS_OF_EVENTS),
        "signal_uid,raw_uid,signal_type,source_family,confidence_score:d,intensity_score:d,source_key,source_record_id,occurred_at,account_hint,product_hint,category_hint,hs_code,shipment_value:d")
    r.add("derive_platform_signals", lambda i: s.derive_platform_signals(
        {"PageView": i.platform_pageviews, "RFQ": i.platform_rfqs, "Lead": i.platform_leads, "Meeting": i.platform_meetings, "Deal": i.platform_deals},
        i.signals_known, AS_OF_EVENTS),
        "signal_uid,source_key,signal_type,source_family,confidence_score:d,intensity_score:d,account_hint,person_hint,product_hint,category_hint")
    r.add("signal_type_of_vendor", lambda i: s.signal_type_of(i.vendor_keys, SourcePrefixes("vendora", "vendorb", "shop")),
          "source_key,event_id,signal_type,source_family")
    r.add("source_registry", lambda i: s.source_registry(i.signals), "kind,src,dst")
    r.add("identity_hypotheses", lambda i: plan(i).hypotheses,
          "hypothesis_id,signal_uid,signal_type,candidate_entity_type,candidate_entity_id,resolution_method,confidence_score:d,status,processing_priority:i")
    r.add("resolve_identity", lambda i: f.resolve_identity(plan(i).hypotheses, i.accounts_known, i.persons_known),
          "hypothesis_id,candidate_entity_type,entity_id,resolution_confidence:d")
    r.add("evidence", lambda i: f.evidence(f.with_evidence(f.with_identity(i.signals), AS_OF_EVENTS)),
          "evidence_uid,signal_uid,hypothesis_id,evidence_type,evidence_category,context_bonus:i,combination_bonus:i,evidence_strength_raw:i,evidence_strength:i,decay_factor:d,signal_age_days:i,signal_confidence:d,product_match:d,contact_exists,rfq_exists,trade_exists,number_of_shipments:d")
    r.add("opportunity_hypotheses", lambda i: f.opportunity_hypotheses(plan(i).evidence),
          "hypothesis_id,evidence_uid,hypothesis_type,rule,threshold:d,confidence:d")
    r.add("fit_scores", lambda i: plan(i).fits,
          "fit_suppression_uid,evidence_uid,behavior_score:d,intent_score:d,trade_score:d,fit_score:d,recency_score:d,reachability_score:d,six_component_score:d,fit_band,suppression_type,final_decision")
    r.add("classify_leads", lambda i: plan(i).classes,
          "classification_uid,fit_suppression_uid,evidence_uid,lead_type,lead_grain,lead_stage,priority,visibility")
    r.add("create_leads", lambda i: plan(i).created, LEAD)
    r.add("dedup_leads", lambda i: tuned(i).leads, LEAD + ",dedup_suppressed", "tuned_dedup_leads")
    r.add("route_leads", lambda i: tuned(i).routed,
          "lead_uid,lead_type,routing_queue,queue_id,seller_id,notification_id,channel,template,urgency,history_id,outcome_id",
          "tuned_route_leads")
    r.add("pipeline_quality", lambda i: plan(i).quality,
          "total_signals:i,signals_without_identity:i,signals_with_identity:i,evidence_missing_strength:i,evidence_invalid_strength:i,leads_without_classification:i,weak_leads:i,total_leads:i,orphaned_identity_hypotheses:i,evidence_without_identity:i,identity_miss_pct:d,evidence_null_pct:d,weak_leads_pct:d,failures:i,failure_messages,passed", "pipeline_quality")
