"""Registered queries: versioned tables, streams into them, published messages. Streams get their events in two parts."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.checks.fixtures import AS_OF_EVENTS, AS_OF_TRADE
from leadloom.checks.queries_platform import profiles
from leadloom.checks.queries_trade import LEAD, OPP, plan
from leadloom.checks.queries_views import MICROS, land_packed, parts_of, work_dir
from leadloom.checks.registry import Registry
from leadloom.operators import behavior, trade
from leadloom.sources import sinks
from leadloom.sources.versioned import VersionedTable
from leadloom.streaming import events as ev
from leadloom.streaming import messages as ms
from leadloom.streaming import tables as st
from leadloom.streaming.leads import LeadStream


def in_parts(rows: DataFrame, folder: str, later, arrive, parts: int | None = None) -> None:
    """Writes the rows before ``later`` holds as JSON lines and lets them arrive, then the rest with some of the first again; in
    packed files where ``parts`` are given."""
    lines = F.to_json(F.struct("*"), MICROS).alias("value")
    first, rest = rows.where(~later), rows.where(later)
    for some in (first, rest.unionByName(first.where("hash(event_key) % 5 = 0"))):
        if parts:
            land_packed(some, folder, MICROS, parts)
        else:
            some.select(lines).write.mode("append").text(folder)
        arrive()


def versioned_nodes(i):
    table = VersionedTable(i.spark, f"{work_dir(i)}/nodes", i.old_table.schema, ["company_id"], most_deltas=1)
    sinks.write_nodes(table, i.old_table, "run", 0)
    for batch in (1, 1):  # the second time it is found applied
        sinks.write_nodes(table, i.new_table, "run", batch)
    sinks.write_nodes(table, i.new_table.where("company_id < '2'").withColumn("name", F.lower("name")), "run", 2)
    return table.read()


def versioned_edges(i):
    pairs = [i.customer.selectExpr("cast(c_nationkey AS string) AS src", "cast(c_custkey AS string) AS dst"),
             i.supplier.selectExpr("cast(s_nationkey AS string) AS src", "cast(s_suppkey AS string) AS dst")]
    table = VersionedTable(i.spark, f"{work_dir(i)}/edges", "src string, dst string", ["src", "dst"])
    for rows in (*pairs, pairs[0], pairs[0].limit(3).withColumn("dst", F.lit(None).cast("string"))):
        sinks.write_edges(table, rows)
    return table.read()


def outbox(i):
    """Relationships, then leads, then some relationships again, of which those sent before are open again."""
    table = VersionedTable(i.spark, f"{work_dir(i)}/outbox", sinks.OUTBOX, ["aggregate_id"])
    rels = sinks.outbox_events(plan(i).rels, sinks.RELATIONSHIP_EVENT, "rel_id", ["rel_id", "buyer_id", "total_shipments"], AS_OF_TRADE)
    leads = sinks.outbox_events(plan(i).matched_leads, sinks.SWITCH_LEAD_EVENT, "lead_id", ["lead_id", "buyer_id", "lead_priority"], AS_OF_TRADE)
    sinks.write_outbox(table, rels)
    sinks.write_outbox(table, leads)
    sinks.mark_processed(table, rels.where("substring(aggregate_id, 1, 1) < '8'"))
    sinks.write_outbox(table, sinks.outbox_events(plan(i).rels.where("total_shipments > 5"), sinks.RELATIONSHIP_EVENT, "rel_id",
                                                  ["rel_id", "total_shipments"], "2001-11-06 00:00:00"))
    return table.read()


def stream_months(i):
    folder = work_dir(i)
    table, seen = st.month_table(i.spark, f"{folder}/months"), st.seen_table(i.spark, f"{folder}/seen")
    in_parts(i.shipment_events, f"{folder}/in", F.col("ship_date") > F.lit("1996-06-01").cast("timestamp"),
             lambda: st.stream_months(table, seen, f"{folder}/in", f"{folder}/state", AS_OF_TRADE), parts_of(i))
    return table.read()


def lead_stream(i) -> LeadStream:
    if "lead_stream" not in i.__dict__:
        folder = work_dir(i)
        made = LeadStream(i.spark, f"{folder}/tables", i, AS_OF_TRADE)
        in_parts(i.shipment_events, f"{folder}/in", F.col("supplier_id").isin("S1", "S2"), lambda: made.run(f"{folder}/in", f"{folder}/state"), parts_of(i))
        i.lead_stream = made
    return i.lead_stream


def profile_table(i):
    folder = work_dir(i)
    table, seen = VersionedTable(i.spark, f"{folder}/profiles", st.PROFILES, ["user_id"]), st.seen_table(i.spark, f"{folder}/seen")

    def apply(rows: DataFrame, batch: int) -> None:
        fresh = st.fresh_rows(seen, st.here(i.spark, rows, f"{folder}/arrived"), batch, "60 days")
        delta = st.profile_totals(ev.route_events(fresh))
        st.merge_totals(table, delta, ["total_sessions", "total_clicks", "high_intent_score"], highs=["last_activity_at"], source="events", batch=batch)
    in_parts(i.web_events, f"{folder}/in", F.col("_polled_at") > F.lit("2024-01-15").cast("timestamp"), lambda: st.run_batches(
        ev.parse_events(ev.read_events(i.spark, f"{folder}/in"), st.as_schema(i.web_events))[0], f"{folder}/state", apply))
    return table.read()


def sales_records(i) -> st.SalesRecords:
    if "sales_records" not in i.__dict__:
        folder = work_dir(i)
        records = st.SalesRecords(i.spark, f"{folder}/records")
        seen = st.seen_table(i.spark, f"{folder}/seen")

        def apply(rows: DataFrame, batch: int) -> None:
            fresh = st.fresh_rows(seen, st.here(i.spark, rows, f"{folder}/arrived"), batch, "60 days")
            records.apply(ev.route_events(fresh), batch)
        in_parts(i.crm_events, f"{folder}/in", F.col("_polled_at") > F.lit("2024-01-15").cast("timestamp"), lambda: st.run_batches(
            ev.parse_events(ev.read_events(i.spark, f"{folder}/in"), st.as_schema(i.crm_events))[0], f"{folder}/state", apply))
        i.sales_records = records
    return i.sales_records


def topic_rows(i) -> dict[str, DataFrame]:
    t = plan(i)
    return {"kg.switch_leads": t.matched_leads, "kg.trade_relationships": t.rels.join(t.health.select("rel_id", "health_score", "health_status"), "rel_id", "left"),
            "kg.buyer_profiles": behavior.behavior_score(profiles(i)),
            "kg.pipeline_runs": i.orders.groupBy("o_orderstatus").agg(F.count("*").alias("rows")).select(
                F.concat(F.lit("run-"), "o_orderstatus").alias("run_id"), F.lit("orders").alias("label"), "rows")}


def published(i):
    """Four topics: all rows through a stream, then the leads of one priority again with another status, twice by one batch name."""
    folder = work_dir(i)
    rows = topic_rows(i)
    every = reduce(DataFrame.unionByName, [ms.messages(r, t, AS_OF_EVENTS) for t, r in rows.items()])
    every.write.parquet(f"{folder}/in")
    source = i.spark.readStream.schema(ms.MESSAGE).parquet(f"{folder}/in")
    ms.publish_stream(source, f"{folder}/out", f"{folder}/state", source="a")
    again = rows["kg.switch_leads"].where("lead_priority = 'high'").withColumn("status", F.lit("sent"))
    for _ in range(2):
        ms.publish(ms.messages(again, "kg.switch_leads", AS_OF_EVENTS), f"{folder}/out", "b-1")
    value = {c: F.get_json_object("value", f"$.{c}") for c in ("event_type", "event_time", "buyer_org_id", "status", "final_lead_score", "health_score",
                                                              "total_shipments", "behavioral_score", "session_count", "rows")}
    latest = ms.latest_messages(i.spark, f"{folder}/out").select("topic", "key", *[v.alias(c) for c, v in value.items()])
    return latest.withColumn("messages", F.lit(ms.published(i.spark, f"{folder}/out").count()))


def register(r: Registry) -> None:
    add = r.add
    add("versioned_nodes", versioned_nodes, "company_id,name,balance:d,origin,created_on,created_by,modified_on,modified_by")
    add("versioned_edges", versioned_edges, "src,dst", "node_edge_sink")
    add("outbox_replaced", outbox, "aggregate_id,event_id,event_type,payload,created_at,processed")
    add("stream_months", stream_months,
        "rel_id,buyer_id,supplier_id,hs_code,year_month:s,buyer_name,supplier_name,shipment_count:i,total_quantity:d,total_value:d,last_shipment_date:s", "monthly_trade")
    add("stream_leads", lambda i: lead_stream(i).leads.read(), LEAD)
    add("stream_opportunities", lambda i: lead_stream(i).opportunities.read(), OPP + ",switch_probability:d", "score_opportunities")
    add("stream_profile_table", profile_table, "user_id,total_sessions:i,total_clicks:i,high_intent_score:i,last_activity_at", "stream_profiles")
    add("stream_sales_leads", lambda i: sales_records(i).leads(), "source_ref,lead_uid,lead_type,score_final:i,visibility_level")
    add("stream_flagged_accounts", lambda i: sales_records(i).suppressed(i.account_leads.where("lead_type is not null")), "lead_uid,suppressed,suppression_reason")
    add("stream_email_steps", lambda i: sales_records(i).scored(i.leads.select("lead_uid", "score_final")), "lead_uid,score_final:i")
    add("published_messages", published,
        "topic,key,event_type,event_time,buyer_org_id,status,final_lead_score:d,health_score:d,total_shipments:s,behavioral_score:s,session_count:s,rows:s,messages:i")
