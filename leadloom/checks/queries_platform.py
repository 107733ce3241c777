"""Registered queries: platform leads and behaviour profiles."""

from pyspark.sql import functions as F

from leadloom.checks.fixtures import AS_OF_EVENTS
from leadloom.checks.queries_trade import plan as trade_plan
from leadloom.checks.registry import Registry
from leadloom.operators import behavior as b
from leadloom.operators import platform_leads as p
from leadloom.operators import switch

LEAD = "lead_uid,lead_type,score_final:i,visibility_level,source,source_ref"
KEYWORDS = 12  # shown in a profile; profile_keywords has all
STATE = "lead_uid,lead_type,score_final:i,visibility_level,classified_at"
PROFILE = "user_id,profile_uid,total_sessions:i,total_page_views:i,product_page_views:i,total_clicks:i,high_intent_score:i,sessions_deep_scroll:i,enquiries_sent:i,quote_requests:i,messages_sent:i,searches_done:i,max_scroll_depth:d,last_activity_at,has_enquiry,high_intent_detail,search_keywords:l,products_viewed_count:i,products_top:l,buyer_countries:l,buyer_devices:l"


def watched(i):
    """Relationships with monthly value as volume and the model's health."""
    t = trade_plan(i)
    return t.rels.select("rel_id", "buyer_id", "buyer_name", "supplier_id", "supplier_name", "total_shipments",
                         F.col("baseline_avg_value").alias("buyer_monthly_volume")).join(
        t.health.select("rel_id", "health_score"), "rel_id", "left")


def rule_opps(i):
    t = trade_plan(i)
    return switch.opportunities_from_rules(t.rules, t.as_of)


def big_switchers(i):
    return rule_opps(i).where("stress_score >= 95 AND buyer_monthly_volume > 70").select(
        "buyer_id", F.lit(None).cast("string").alias("buyer_name"))


def profiles(i):
    return b.buyer_profiles(i.sessions, i.clicks, i.scrolls, i.page_views, i.searches, i.messages, i.enquiries, i.rfqs,
                            i.button_events, keywords=KEYWORDS)


def register(r: Registry) -> None:
    add = r.add
    add("reclassify_untyped", lambda i: p.reclassify_untyped(i.leads, AS_OF_EVENTS), STATE)
    add("promote_cold_market", lambda i: p.promote_cold_market(i.leads, AS_OF_EVENTS), STATE)
    add("rfq_leads", lambda i: p.rfq_leads(i.rfqs, i.leads), LEAD + ",rfq_id,status")
    add("meeting_leads", lambda i: p.meeting_leads(i.meetings, i.leads), LEAD + ",meeting_id,host_email")
    add("pageview_leads", lambda i: p.pageview_leads(i.view_signals, i.leads), LEAD + ",account_hint,pageview_count:i,first_seen,last_seen")
    add("anonymous_leads", lambda i: p.anonymous_leads(i.ghosts, i.leads), LEAD + ",profile_id,confidence:d")
    add("intent_leads", lambda i: p.intent_leads(i.signals, i.leads), LEAD + ",account_hint,trigger_count:s,last_seen")
    add("trade_buyer_leads", lambda i: p.trade_buyer_leads(i.signals, i.leads), LEAD + ",account_key")
    add("engaged_person_leads", lambda i: p.engaged_person_leads(i.buyer_details, i.engagements, i.leads),
        LEAD + ",contact_name,contact_email,company_name,buyer_user_id,crm_lead_id")
    add("quotation_leads", lambda i: p.quotation_leads(i.quotations, i.leads), LEAD + ",product_name,total_cost:d,quotation_status")
    add("enquiry_leads", lambda i: p.enquiry_leads(i.enquiries, i.leads),
        LEAD + ",buyer_user_id,seller_user_id,product_id,message,buyer_country,buyer_industry,competitor,enquiry_type")
    add("session_leads", lambda i: p.session_leads(i.page_views, i.sessions, i.leads),
        LEAD + ",session_id,user_id:i,pageview_count:i,product_views:i,page_types,first_seen,last_seen")
    add("search_leads", lambda i: p.search_leads(i.searches, i.leads), LEAD + ",user_id:i,keyword,category_id,search_count:i,last_searched")
    add("competitor_leads", lambda i: p.competitor_leads(i.enquiries, i.leads), LEAD + ",buyer_user_id,seller_user_id,product_id,current_supplier,message,buyer_country,enquiry_type")
    add("strategic_watch", lambda i: p.strategic_watch(watched(i), i.leads, big_switchers(i), i.leads),
        LEAD + ",company_name,buyer_org_id,buyer_monthly_volume:d,trade_health_score:d,trade_relationship_count:i")
    add("reactivation_leads", lambda i: p.reactivation_leads(i.deals, i.leads, AS_OF_EVENTS), LEAD + ",deal_amount:d")
    add("partner_leads", lambda i: p.partner_leads(i.enquiries, i.leads), LEAD + ",partner_type,buyer_user_id,buyer_country")
    add("noise_leads", lambda i: p.noise_leads(i.risk_flags, i.leads),
        LEAD + ",account_uid,suppression_reason,risk_severity,suppressed,seller_visible,distribution_status")
    add("exporter_leads", lambda i: p.exporter_leads(watched(i), i.platform_sellers, i.leads),
        LEAD + ",company_name,buyer_org_id,trade_relationship_count:i,avg_trade_health:d,total_shipments:i")
    add("playbook_tags", lambda i: p.playbook_tags(i.leads.withColumn("playbook_tags", F.when(
        F.col("status_id").isNotNull(), F.array(F.lit("own"))))).withColumn(
        "playbook_tags", F.coalesce(F.array_join("playbook_tags", ","), F.lit(""))), "lead_uid,lead_type,playbook_tags")
    add("lead_type_distribution", lambda i: p.lead_type_distribution(i.leads, rule_opps(i)), "lead_type,leads:i")
    add("click_weights", lambda i: b.click_weights(i.clicks, "element_type", False), "id,element_type,weight:i")
    add("buyer_profiles", profiles, PROFILE)
    add("profile_keywords", lambda i: b.profile_keywords(i.searches), "user_id,keyword,searches:i,most_at_once:i")
    add("profile_products", lambda i: b.profile_products(i.page_views, i.sessions), "user_id,product_id,views:i")
    add("behavior_score", lambda i: b.behavior_score(profiles(i)), "user_id,behavioral_score:i")
    add("profile_lead_type", lambda i: b.profile_lead_type(b.behavior_score(profiles(i))),
        "user_id,behavioral_score:i,lead_type_signal,lead_score:i")
    add("click_intent_leads", lambda i: b.click_intent_leads(b.profile_lead_type(b.behavior_score(profiles(i))), i.leads),
        LEAD + ",buyer_user_id,high_intent_score:i,click_detail,behavioral_score:i")
    add("enrich_leads_with_behavior", lambda i: b.enrich_leads_with_behavior(i.leads, b.behavior_score(profiles(i))),
        "lead_uid,buyer_user_id,behavioral_score:s,high_intent_score:s,total_sessions:s,profile_uid")
    add("behavior_summary", lambda i: b.behavior_summary(b.behavior_score(profiles(i))),
        "total_profiles:i,avg_score:d,high_intent:i,enquiry_buyers:i,strong_clickers:i,deep_readers:i,chatted:i")
    add("top_engaged", lambda i: b.top_engaged(b.behavior_score(profiles(i)), 5), "user_id,behavioral_score:i,high_intent_detail")
    add("visit_facts", lambda i: b.visit_facts(i.visits),
        "utm_source,utm_campaign,visits:i,users:i,mean_scroll_depth:d,mean_stay:d,clicks:i")
