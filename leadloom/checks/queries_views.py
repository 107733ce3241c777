"""Registered queries: views and streams."""

import uuid
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.checks.fixtures import AS_OF_EVENTS, AS_OF_TRADE
from leadloom.checks.queries_platform import profiles
from leadloom.checks.queries_sellers import facts
from leadloom.checks.queries_trade import plan
from leadloom.checks.registry import Registry
from leadloom.operators import behavior as b
from leadloom.operators import enrich
from leadloom.operators import views as v
from leadloom.session import shared_dir, shuffles_dropped
from leadloom.streaming import events as ev
from leadloom.streaming import trade as st


def valued(i):
    t = plan(i)
    return t.rels.select("rel_id", "buyer_name", "supplier_name", "hs_code", "total_shipments", F.col("baseline_avg_value").alias(
        "buyer_monthly_volume")).join(t.health.select("rel_id", "health_score", "health_status"), "rel_id", "left")


def scored_profiles(i):
    return b.behavior_score(profiles(i))


def enriched(i):
    t = plan(i)
    rels = t.rels.join(t.health.select("rel_id", "health_score", "health_status"), "rel_id", "left")
    return v.enriched_leads(t.matched_leads, t.scored, rels, AS_OF_TRADE, best_per_buyer=True)


def every_assignment(i):
    """Assignments of leads, and of switch leads to two sellers each."""
    switch = plan(i).matched_leads.select("lead_id", F.explode(F.array(F.lit("SL1"), F.concat(F.lit("SL"), F.substring("lead_id", 1, 1)))).alias("seller_id"))
    switch = switch.distinct().select(F.concat(F.lit("sw:"), "seller_id", F.lit(":"), "lead_id").alias("assignment_id"), "seller_id", "lead_id", F.lit("assigned").alias("status"))
    return i.assignments.select("assignment_id", "seller_id", "lead_id", "status").unionByName(switch)


def result_tables(i):
    return {"Lead": i.leads, "BuyerProfile": scored_profiles(i), "TradeRelationship": plan(i).rels, "SwitchLead": plan(i).matched_leads,
            "SupplierSwitchOpportunity": plan(i).opportunities, "Seller": i.sellers, "SellerLeadAssignment": i.assignments,
            "ConversionFact": facts(i)}


LINES = 400_000  # most lines of a landed file, which is packed and so is read by one task
MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def work_dir(i) -> str:
    return f"{shared_dir(i.spark)}/leadloom/{uuid.uuid4().hex}"


def land(lines: DataFrame, folder: str) -> int:
    """Writes text lines, partitioned as they come; returns the files of a batch when the stream has two batches."""
    lines.write.text(folder)
    files = lines.sparkSession.read.text(folder).select(F.col("_metadata.file_path")).distinct().count()
    return max(1, ceil(files / 2))


def land_packed(rows: DataFrame, folder: str, options: dict[str, str], parts: int) -> None:
    """Adds rows as JSON lines to a landing folder, in packed files of a bounded number of lines, and by their event_key in so many
    parts, one after another: what it takes to make them is not on disk at once."""
    with shuffles_dropped(rows.sparkSession):
        for part in range(parts):
            some = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("event_key"), F.lit(parts)) == part)
            some.select(F.to_json(F.struct("*"), options).alias("value")).write.mode("append").option("compression", "gzip").option(
                "maxRecordsPerFile", LINES).text(folder)


def batch_files(i, folder: str) -> int:
    """Files of a batch when the stream has two batches; no more than make a batch of bounded size."""
    files = i.spark.read.text(folder).select(F.col("_metadata.file_path")).distinct().count()
    return min(max(1, ceil(files / 2)), 100)


def parts_of(i) -> int:
    """Parts in which shipment events are made and landed."""
    return max(1, ceil(i.lineitem.count() / 20_000_000))


def web_stream(i, folder: str):
    """Web events as JSON lines in a landing folder, a part of them delivered twice, read as a stream."""
    rows = i.web_events
    per_batch = land(rows.unionByName(rows.where("topic = 'crm.buyer_clicks'")).select(F.to_json(F.struct("*"), MICROS).alias("value")), f"{folder}/in")
    schema = T.StructType([T.StructField(f.name, T.TimestampType() if f.name == "_polled_at" else T.StringType()) for f in rows.schema])
    good, _ = ev.parse_events(ev.read_events(i.spark, f"{folder}/in", files_per_batch=per_batch), schema)
    return ev.dedup_events(good, within="60 days")


def stream_result(i, stream_of, keys):
    folder = work_dir(i)
    ev.run_to_log(stream_of(web_stream(i, folder)), f"{folder}/log", f"{folder}/state")
    return ev.current(i.spark, f"{folder}/log", keys)


def deduped(i):
    folder = work_dir(i)
    ev.run_to_log(web_stream(i, folder).select("event_key", "user_id", "topic"), f"{folder}/log", f"{folder}/state", "append")
    return i.spark.read.parquet(f"{folder}/log")


def read(i):
    """Web events through the file source, repeats included."""
    folder = work_dir(i)
    i.web_events.select(F.to_json(F.struct("*"), MICROS).alias("value")).write.text(f"{folder}/in")
    schema = T.StructType([T.StructField(f.name, T.TimestampType() if f.name == "_polled_at" else T.StringType()) for f in i.web_events.schema])
    good, _ = ev.parse_events(ev.read_events(i.spark, f"{folder}/in"), schema)
    ev.run_to_log(good, f"{folder}/log", f"{folder}/state", "append")
    return i.spark.read.parquet(f"{folder}/log")


def trade_log(i) -> str:
    folder = work_dir(i)
    rows = i.shipment_events
    land_packed(rows.unionByName(rows.where("quantity > 40")), f"{folder}/in", {}, parts_of(i))
    st.stream_trade(i.spark, f"{folder}/in", f"{folder}/log", f"{folder}/state", AS_OF_TRADE, files_per_batch=batch_files(i, f"{folder}/in"))
    return f"{folder}/log"


def ref(kind: str):
    return F.concat(F.lit(f"{kind}:"), F.col("id"))


def register(r: Registry) -> None:
    add = r.add
    add("trade_view", lambda i: v.trade_view(valued(i), plan(i).opportunities, 1000, "stressed"),
        "rel_id,buyer_name,supplier_name,hs_code,total_shipments:i,buyer_monthly_volume:d,health_score:d,health_status,opportunity_count:i")
    add("trade_stats", lambda i: v.trade_stats(valued(i)),
        "total_relationships:i,total_monthly_volume:d,avg_monthly_volume:d,max_monthly_volume:d,avg_health_score:d,churned:i,dormant:i,stressed:i,irregular:i,healthy:i")
    add("profile_view", lambda i: v.profile_view(scored_profiles(i), 50, True, "high"), "user_id,behavioral_score:i,enquiries_sent:i,intent_band")
    add("profile_stats", lambda i: v.profile_stats(scored_profiles(i)),
        "total_profiles:i,avg_behavioral_score:d,high_intent:i,medium_intent:i,low_intent:i,with_enquiries:i,deep_readers:i,platform_clicks:i,total_enquiries:i")
    add("opportunity_view", lambda i: v.opportunity_view(plan(i).scored, plan(i).health),
        "opportunity_id,rel_id,detection_method,health_score:d,health_status,switch_probability:d")
    add("detection_comparison", lambda i: v.detection_comparison(plan(i).scored, plan(i).health),
        "detection_method,total:i,avg_health_score:d,avg_switch_prob_pct:d,churned:i,dormant:i,stressed:i")
    add("pipeline_counts", lambda i: v.pipeline_counts(result_tables(i)), "label,rows:i")
    add("pipeline_status", lambda i: v.pipeline_status(result_tables(i), i.leads, plan(i).opportunities), "part,label,rows:s,latest_at")
    add("enriched_leads", enriched,
        "lead_id,buyer_name,existing_supplier_name,candidate_supplier_name,hs_code,hs_description,final_lead_score:d,urgency,health_score:d,monthly_volume:d,total_shipments:i,months_since_last:i,act_within_two_weeks")
    add("decision_makers", lambda i: v.decision_makers(i.company_search.select(F.col("company_name").alias("company")), _people(i)),
        "company,person_key,title,email,is_maker,rank:i")
    add("lead_summary", lambda i: v.lead_summary(plan(i).matched_leads, plan(i).rels, plan(i).opportunities),
        "total_switch_leads:i,trade_relationships_monitored:i,stressed_relationships:i")
    add("seller_dashboard", lambda i: v.seller_dashboard(i.sellers, i.assignments, i.accounts, "2001-08-01 00:00:00"),
        "seller_id,name,tier,total_assigned:i,converted:i,rejected:i,new_last_7d:i,credits_available:d,conversion_rate_pct:d,credits_unlimited,credits_used_pct:d")
    add("seller_performance", lambda i: v.seller_performance(i.assignments, i.leads),
        "seller_id,lead_type,total:i,converted:i,rejected:i,avg_score:d,conv_rate_pct:d")
    add("assigned_leads", lambda i: v.assigned_leads(
        every_assignment(i), i.lead_tags, plan(i).matched_leads, page=1, page_size=20).withColumn(
        "action_steps", F.array_join("action_steps", ",")),
        "assignment_id,seller_id,lead_id,lead_type,priority,score:d,rank:i,hs_description,action_steps,urgency")
    add("sellers_list", lambda i: v.sellers_list(i.sellers, i.accounts), "seller_id,name,tier,active,max_leads_per_day:i,leads_today:i,credits_available:d")
    # streams
    add("route_events", lambda i: ev.route_events(i.web_events).withColumn("source_table", F.col("_source_table")),
        "event_key,topic,source_table,handler,button_identity,user_id,element_type")
    add("read_events", read, "event_key,user_id,topic,_polled_at")
    add("dedup_events", deduped, "event_key,user_id,topic")
    add("stream_trade", lambda i: st.months_of(i.spark, trade_log(i)),
        "rel_id,buyer_id,supplier_id,hs_code,year_month:s,buyer_name,supplier_name,shipment_count:i,total_quantity:d,total_value:d,last_shipment_date:s")
    add("stream_stress", lambda i: st.stream_stress(i.spark, trade_log(i), AS_OF_TRADE),
        "rel_id,buyer_id,supplier_id,hs_code,rule_status,rule_score:d,rule_reason,rule_vol_drop_pct:d")
    add("stream_profiles", lambda i: stream_result(i, lambda s: ev.stream_profiles(ev.route_events(s)), ["user_id"]),
        "user_id,total_sessions:i,total_clicks:i,high_intent_score:i,last_activity_at")
    add("stream_rfq", lambda i: ev.rfq_status_leads(stream_result(i, lambda s: ev.latest_status(s.withColumn(
        "enquiry_type", F.lit("")), ref("rfq")), ["source_ref"])), "source_ref,lead_type,score_final:i")
    add("stream_lead_update", lambda i: ev.lead_update_leads(stream_result(i, lambda s: ev.latest_status(s, ref("crm_lead")), ["source_ref"])),
        "source_ref,lead_type,score_final:i")
    add("stream_deals", lambda i: ev.deal_leads(stream_result(i, lambda s: ev.latest_status(s, ref("deal")), ["source_ref"])),
        "source_ref,lead_type,score_final:i,visibility_level")
    add("stream_risk", lambda i: ev.suppress_accounts(i.account_leads.where("lead_type is not null"), i.flag_events),
        "lead_uid,suppressed,suppression_reason")
    add("stream_identity", lambda i: ev.copy_account_fields(i.account_leads, i.identities, i.masters),
        "lead_uid,identity_confidence:d,org_name_resolved,crm_status,crm_score:d")
    add("stream_email", lambda i: ev.email_scores(i.leads, i.emails), "lead_uid,score_final:i")
    window = "user_id,start,end,events:i,value:d"
    for kind in ("tumbling", "sliding", "session"):
        add(f"activity_{kind}", lambda i, k=kind: ev.activity_windows(i.events, k), window.replace(",end", ""))
    add("publish_events", lambda i: ev.publish_events(scored_profiles(i), "kg.buyer_profiles", "user_id",
                                                      "buyer_profile.score_updated", AS_OF_EVENTS), "topic,key,value")
    add("cdc_route", lambda i: ev.cdc_route(i.changes), "topic,key,value")


def _people(i):
    """Contacts under their company's whole name, where ``contacts`` has its first 17 characters."""
    return enrich.contacts(i.named_contact_rows)
