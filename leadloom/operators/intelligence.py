"""Scores derived from counts of linked records.

Every linked table is reduced to one row per entity before the joins (counts of distinct keys by
two-level aggregation), so the joins are one to one and a hot entity is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.values import choose


def linked(base: DataFrame, key: str, **links: DataFrame) -> DataFrame:
    """The keys with one count per link: distinct ``id`` values of frames (key, id); 0 where none."""
    out = base.select(key).distinct()
    for name, frame in links.items():
        per = frame.where(F.col("id").isNotNull()).groupBy(key, "id").agg(F.lit(1).alias("one")).groupBy(key).agg(
            F.count(F.lit(1)).alias(name))
        out = out.join(per, key, "left")
    return out.na.fill(0, list(links))


def account_intent(accounts: DataFrame, views: DataFrame, rfqs: DataFrame, deals: DataFrame) -> DataFrame:
    """Views + 5 RFQs + 8 deals per active account; commercial once there is an RFQ or deal."""
    rows = linked(accounts, "account_id", page_views=views, rfqs=rfqs, deals=deals)
    rows = rows.where("page_views + rfqs + deals > 0")
    buying = (F.col("rfqs") > 0) | (F.col("deals") > 0)
    return rows.select(
        F.concat(F.lit("intent:account:"), "account_id").alias("intent_id"), "account_id", "page_views", "rfqs", "deals",
        F.when(buying, "commercial_buying").otherwise("behavioral_interest").alias("intent_type"),
        (F.col("page_views") + F.col("rfqs") * 5.0 + F.col("deals") * 8.0).alias("score"))


def intent_signals(intents: DataFrame, views: DataFrame, rfqs: DataFrame, deals: DataFrame) -> DataFrame:
    """The signals behind each intent: (intent_id, signal_id, signal_type, weight)."""
    ids = intents.select("account_id", "intent_id")
    out = None
    for frame, name, kind, weight in ((views, "pv", "page_view", 1.0), (rfqs, "rfq", "rfq_created", 5.0), (deals, "deal", "deal_progress", 8.0)):
        part = frame.where(F.col("id").isNotNull()).join(ids, "account_id").select(
            "intent_id", F.concat(F.lit(f"signal:{name}-intent:"), F.col("id").cast("string")).alias("signal_id"),
            F.lit(kind).alias("signal_type"), F.lit(weight).alias("weight")).distinct()
        out = part if out is None else out.unionByName(part)
    return out


def lead_prediction(leads: DataFrame, **links: DataFrame) -> DataFrame:
    """Conversion score and evidence of leads from rfqs, deals, threads, sources and touches."""
    rows = linked(leads, "lead_id", **links)
    c = F.col
    evidence = c("sources") + c("rfqs") + c("deals") + c("touches")
    return rows.withColumns({
        "score": c("rfqs") * 20.0 + c("deals") * 35.0 + c("threads") * 8.0 + c("sources") * 5.0 + c("touches") * 4.0,
        "evidence_count": evidence, "truth_confidence": evidence / 10.0})


def org_evidence(orgs: DataFrame, sells: DataFrame, facilities: DataFrame, supplied: DataFrame, target_views: DataFrame) -> DataFrame:
    rows = linked(orgs, "org_id", sells=sells, facilities=facilities, supplied=supplied, target_views=target_views)
    depth = F.col("sells") + F.col("facilities") + F.col("supplied")
    total = depth + F.col("target_views")
    return rows.withColumns({"evidence_count": total, "confidence": total / 10.0, "source_depth": depth})


def competitor_brands(store_owners: DataFrame, sells: DataFrame, brands: DataFrame) -> DataFrame:
    """Brands each store-owning organisation sells: (competitor_id, org_id, brand, evidence_score)."""
    rows = store_owners.select("org_id").distinct().join(sells, "org_id").join(brands, "product_id").where(
        "brand is not null").select("org_id", "brand").distinct()
    counts = rows.groupBy("org_id").agg(F.count(F.lit(1)).alias("evidence_score"))
    return rows.join(counts, "org_id").select(
        F.concat(F.lit("competitor:"), "org_id", F.lit(":"), F.replace(F.lower("brand"), F.lit(" "), F.lit("_"))).alias("competitor_id"),
        "org_id", "brand", "evidence_score")


def interest_findings(views: DataFrame) -> DataFrame:
    """Findings of page views with product and seller: time spent + 1."""
    return views.where("product_id is not null and seller_id is not null").select(
        F.concat(F.lit("finding:pageview:"), F.col("id").cast("string")).alias("finding_id"), "product_id", "seller_id",
        F.lit("product_interest").alias("finding_type"), (F.coalesce("time_spent", F.lit(0.0)) + 1).alias("score"))


def buyer_committees(buyers: DataFrame, threads: DataFrame, meetings: DataFrame, account_orgs: DataFrame) -> DataFrame:
    """Committees of leads with buyers and threads or meetings; the organisation is the smallest id of its members'."""
    rows = linked(buyers, "lead_id", members=buyers, threads=threads, meetings=meetings).where(
        "members > 0 and (threads > 0 or meetings > 0)")
    org = buyers.select("lead_id", F.col("id").alias("account_id")).join(account_orgs, "account_id").groupBy("lead_id").agg(
        F.min("org_id").alias("org_id"))
    return rows.join(org, "lead_id", "left").select(
        F.concat(F.lit("committee:"), "lead_id").alias("committee_id"), "lead_id", F.col("members").alias("size"),
        "threads", "meetings", ((F.col("members") + F.col("threads") + F.col("meetings")) / 10.0).alias("confidence"), "org_id")


def deal_prediction(deals: DataFrame, stages: DataFrame, leads: DataFrame, legs: DataFrame) -> DataFrame:
    """Win score of deals, with the escrow fields (amount, status)."""
    rows = linked(deals, "deal_id", stages=stages, leads=leads, legs=legs).join(
        deals.select("deal_id", F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"),
                     F.coalesce("status", F.lit("unknown")).alias("escrow_status")), "deal_id")
    return rows.withColumn("score", F.col("stages") * 10.0 + F.col("leads") * 20.0 + F.col("legs") * 4.0
                           + F.when(F.col("amount") > 0, 10.0).otherwise(0.0))


def lead_waterfall(leads: DataFrame, sources: DataFrame, rfqs: DataFrame, deals: DataFrame, threads: DataFrame) -> DataFrame:
    rows = linked(leads, "lead_id", source_depth=sources, rfqs=rfqs, deals=deals, threads=threads)
    return rows.withColumn("evidence_count", F.col("source_depth") + F.col("rfqs") + F.col("deals") + F.col("threads"))


def _action(rows: DataFrame) -> tuple[Column, Column]:
    deal, thread = F.col("deals") > 0, F.col("threads") > 0
    return (choose([(deal, "high"), (thread, "medium")], "normal"),
            choose([(deal & (F.col("tasks") == 0), "create_followup_task"), (thread, "continue_thread_nurture"),
                    (F.col("buyers") > 0, "assign_to_seller")], "research_lead"))


def next_best_action(leads: DataFrame, deals: DataFrame, threads: DataFrame, tasks: DataFrame, buyers: DataFrame) -> DataFrame:
    """Priority and next action of leads and of threads: (dispatcher_id, priority, action)."""
    rows = linked(leads, "lead_id", deals=deals, threads=threads, tasks=tasks, buyers=buyers)
    priority, action = _action(rows)
    of_leads = rows.select(F.concat(F.lit("dispatch:lead:"), "lead_id").alias("dispatcher_id"), priority.alias("priority"), action.alias("action"))
    per_thread = threads.groupBy(F.col("id").cast("string").alias("thread_id")).agg(F.count("lead_id").alias("n"))
    of_threads = per_thread.where("thread_id is not null").select(
        F.concat(F.lit("dispatch:thread:"), "thread_id").alias("dispatcher_id"), F.lit("medium").alias("priority"),
        F.when(F.col("n") > 0, "link_thread_to_lead_workflow").otherwise("triage_thread").alias("action"))
    return of_leads.unionByName(of_threads)
