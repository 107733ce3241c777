"""Registered queries: trade, enrichment, health, switch leads."""

from pyspark.sql import functions as F

from leadloom.checks.fixtures import AS_OF_TRADE
from leadloom.checks.registry import Registry
from leadloom.operators import enrich, health, switch, trade
from leadloom.plans.trade import OrgPlan, TradePlan

REL = "rel_id,buyer_id,buyer_name,supplier_id,supplier_name,hs_code,hs_chapter,total_shipments:i,relationship_age_months:i,baseline_avg_qty:d,baseline_avg_value:d,last_shipment_date:s,data_source"
SNAP = "snapshot_id,rel_id,year_month:s,shipment_count:i,total_quantity:d,total_value:d,qty_vs_baseline_pct:d"
OPP = "opportunity_id,rel_id,buyer_id,buyer_name,existing_supplier_id,existing_supplier_name,hs_code,stress_reason,stress_score:d,buyer_monthly_volume:d,detection_method,status,first_detected_at"
FEAT = "rel_id,mean_qty:d,cv_qty:d,slope:d,zero_frac:d,recent_vs_baseline:d,n_months:i"
HEALTH = "rel_id,anomaly_score:d,trend_direction,health_score:d,health_status"
LEAD = "lead_id,opportunity_id,match_id,buyer_id,buyer_name,candidate_supplier_id,candidate_supplier_name,hs_code,stress_reason,switch_probability:d,match_score:d,final_lead_score:d,lead_priority,buyer_monthly_volume:d,recommended_action,contact_name,contact_title,contact_email,status"


def plan(i) -> TradePlan:
    """The trade plan of these inputs, made once so its stages are shared."""
    if "trade_plan" not in i.__dict__:
        i.trade_plan = TradePlan(i, AS_OF_TRADE)
    return i.trade_plan


def monthly(i):
    return trade.monthly_trade(i.shipments, AS_OF_TRADE)


def register(r: Registry) -> None:
    r.add("monthly_trade", lambda i: trade.monthly_trade(i.shipments, AS_OF_TRADE),
          "rel_id,buyer_id,supplier_id,hs_code,year_month:s,buyer_name,supplier_name,shipment_count:i,total_quantity:d,total_value:d,last_shipment_date:s")
    r.add("trade_baseline", lambda i: trade.trade_baseline(monthly(i)),
          "rel_id,baseline_avg_qty:d,baseline_avg_value:d,baseline_months:i")
    r.add("trade_relationships", lambda i: trade.trade_relationships(monthly(i)), REL + ",last_month:s")
    r.add("trade_snapshots", lambda i: trade.trade_snapshots(monthly(i)), SNAP)
    r.add("relationships_from_partners", lambda i: plan(i).partners, REL + ",from_date:s,to_date:s")
    r.add("synthetic_months", lambda i: trade.synthetic_months(plan(i).partners, AS_OF_TRADE), SNAP)
    r.add("relationships_from_codes", lambda i: plan(i).crossmatch, REL)
    r.add("union_trade_sources", lambda i: plan(i).all_relationships, REL)
    r.add("apply_external_health", lambda i: plan(i).external,
          "rel_id,buyer_id,supplier_id,anomaly_score:d,external_health_score:d,health_score:d")
    r.add("match_profiles", lambda i: enrich.match_profiles(i.profiles, i.orgs),
          "org_id,company_id,matched_by,trade_health_score:d,supplier_risk_score:d,total_shipment_count:i,company_type")
    r.add("enrich_orgs_by_name", lambda i: enrich.enrich_orgs_by_name(i.orgs, i.company_search),
          "org_id,matched_company,employee_count:i,industry,company_domain,company_country")
    r.add("contacts", lambda i: OrgPlan(i).people,
          "person_key,name,title,email,phone,company_name,seniority_level,is_decision_maker")
    r.add("contact_links", lambda i: enrich.contact_links(OrgPlan(i).people, i.orgs), "person_key,org_id")
    r.add("intent_per_company", lambda i: OrgPlan(i).intent,
          "company_name,intent_signal_count:i,intent_topics,last_intent_date")
    r.add("news_flags", lambda i: OrgPlan(i).news,
          "company_name,news_count:i,last_news_date,has_leadership_change,has_funding_event,has_ma_event")
    r.add("org_intent", lambda i: enrich.matched_by_name(i.orgs, OrgPlan(i).intent),
          "org_id,company_name,intent_signal_count:i,intent_topics,last_intent_date")
    r.add("org_news", lambda i: enrich.matched_by_name(i.orgs, OrgPlan(i).news),
          "org_id,company_name,news_count:i,last_news_date,has_leadership_change,has_funding_event,has_ma_event")
    r.add("stress_rules", lambda i: plan(i).rules,
          "rel_id,buyer_id,buyer_name,supplier_id,supplier_name,hs_code,baseline_avg_qty:d,rule_status,rule_score:d,rule_reason,rule_days_silent:i,rule_vol_drop_pct:d")
    r.add("series_features", lambda i: health.series_features(plan(i).snapshots), FEAT)
    r.add("anomaly_statistical", lambda i: plan(i).anomalies, FEAT + ",anomaly_score:d")
    r.add("health_status", lambda i: plan(i).health, HEALTH)
    r.add("stress_reason", lambda i: plan(i).reasons, HEALTH + ",stress_reason")
    r.add("switch_opportunities", lambda i: plan(i).opportunities, OPP)
    r.add("score_opportunities", lambda i: plan(i).scored, OPP + ",switch_probability:d")
    r.add("relationship_features", lambda i: plan(i).features,
          "rel_id,buyer_id,supplier_id,hs_code,relationship_age_months:i,total_shipments:i,baseline_avg_qty:d,last_shipment_date_days_ago:i,qty_trend_3m:d,qty_trend_6m:d,shipment_regularity:d,months_with_zero_shipments:i,buyer_total_supplier_count:i,buyer_employee_count:i,buyer_industry_encoded:i,buyer_intent_signal_count:i,buyer_has_leadership_change:i,buyer_has_funding_event:i,buyer_has_ma_event:i,supplier_active_buyer_count:i,supplier_recent_export_volume:d,hs_code_market_supplier_count:i,anomaly_score:d")
    r.add("candidate_suppliers", lambda i: plan(i).candidates,
          "hs_code,supplier_id,supplier_name,active_buyer_count:i,recent_export_volume:d,employee_count:i,has_contact:i,export_recency_days:i,hs_prefix,own_points:d")
    r.add("rank_heuristic", lambda i: switch.rank_heuristic(plan(i).candidates.withColumns({
        "hs_exact_match": F.col("active_buyer_count") % 2, "hs_chapter_match": F.lit(1),
        "exports_to_buyer_country": F.col("has_contact")})), "hs_code,supplier_id,raw_score:d")
    r.add("match_suppliers", lambda i: plan(i).matches,
          "match_id,opportunity_id,candidate_supplier_id,candidate_supplier_name,hs_code_match_type,match_score:d,rank:i,active_buyer_count:i,exports_to_buyer_country,has_contact")
    r.add("switch_leads_matched", lambda i: plan(i).matched_leads, LEAD)
    r.add("switch_leads_unmatched", lambda i: plan(i).unmatched_leads, LEAD)
