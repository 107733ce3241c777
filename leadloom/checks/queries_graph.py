"""Registered queries: entities, governance, provenance, intelligence."""

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.checks.registry import Registry
from leadloom.operators import entities as e
from leadloom.operators import governance as g
from leadloom.operators import intelligence as n
from leadloom.operators import provenance as p


def nodes(i, label: str, rows):
    return e.entity_nodes(rows, label, "test")


def all_nodes(i):
    parts = {"Account": (i.g_accounts, "name"), "Organization": (i.g_orgs, "name"), "Store": (i.g_stores, "slug"),
             "Product": (i.g_products, "name")}
    out = None
    for label, (rows, name) in parts.items():
        part = nodes(i, label, rows).select(F.lit(label).alias("label"), F.col(e.ENTITIES[label].key).alias("key"), F.col(name).alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


def edge(kind: str, src: str, dst: str) -> e.Edge:
    return next(x for x in e.EDGES if (x.kind, x.src, x.dst) == (kind, src, dst))


def all_edges(i):
    made = {label: nodes(i, label, rows) for label, rows in (
        ("Account", i.g_accounts), ("Organization", i.g_orgs), ("Product", i.g_products), ("Category", i.g_categories))}
    out = e.entity_edges(i.g_products, edge("HAS_CATEGORY", "Product", "Category"), made["Product"], made["Category"])
    out = out.unionByName(e.entity_edges(i.g_orgs, edge("OWNS", "Account", "Organization"), made["Account"], made["Organization"]))
    return out.unionByName(e.entity_edges(i.g_products, edge("SUPPLIED_BY", "Product", "Organization"), made["Product"], made["Organization"]))


def every_node(i):
    """All entities, one row per node and column."""
    parts = []
    for label, spec in e.ENTITIES.items():
        made, fields = nodes(i, label, i[f"ent_{label}"]), [*spec.columns, *spec.dates]
        parts.append(made.select(F.lit(label).alias("label"), F.col(spec.key).alias("key"), F.explode(F.array(*[
            F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("f")).select("label", "key", "f.*"))
    return reduce(DataFrame.unionByName, parts)


def every_edge(i):
    """All kinds of edges between nodes that exist; rows that hold one column for both ends name the second apart."""
    parts = []
    for n, kind in enumerate(e.EDGES):
        rows = i[f"edge_{n}"]
        twin = next((c for c in rows.columns if c.endswith("_2")), None)
        if twin:
            kind = replace(kind, dst_columns=(twin,))
        ends = (nodes(i, label, i[f"ent_{label}"]) for label in (kind.src, kind.dst))
        made = e.entity_edges(rows, kind, *ends)
        parts.append(made.withColumn("kind", F.lit(f"{kind.src} {kind.kind} {kind.dst}")))
    return reduce(DataFrame.unionByName, parts)


def link(i, col: str):
    return i.ll.select("lead_id", F.col(col).alias("id"))


def sold(i):
    return e.seller_products(i.g_products.select(F.col("user_id").cast("string").alias("account_id"), "product_id"), i.account_orgs)


def ghosts(i):
    return p.device_identity(i.ip_visits, i.sessions, i.sessions.where("user_id > 0"))


def intents(i):
    return n.account_intent(i.g_accounts, i.l_views, i.l_rfqs, i.l_deals)


def as_org(rows):
    return rows.withColumnRenamed("lead_id", "org_id")


def register(r: Registry) -> None:
    add = r.add
    add("all_entity_nodes", every_node, "label,key,field,value")
    add("all_entity_edges", every_edge, "src,kind,dst")
    add("entity_nodes", all_nodes, "label,key,name")
    add("account_emails", lambda i: e.account_emails(nodes(i, "Account", i.g_accounts)), "accountId,emailId,email")
    add("entity_edges", all_edges, "src,kind,dst")
    add("split_keywords", lambda i: i.g_products.select("product_id", F.array_join(e.split_keywords("words"), ",").alias("keywords")),
        "product_id,keywords")
    add("keyword_use_cases", lambda i: e.keyword_use_cases(
        e.keyword_nodes(i.g_products, "product_id", e.split_keywords("words")),
        e.keyword_nodes(i.g_use_cases, "use_case_id", e.split_keywords("words"))), "product_id,use_case_id:i")
    add("seller_products", sold, "org_id,product_id")
    add("category_tree", lambda i: e.category_tree(i.g_categories), "root:i,node:i,parent:i,name,level:i")
    add("classify_accounts", lambda i: e.classify_accounts(
        i.g_accounts, i.g_orgs, i.l_rfqs.select(F.col("account_id").alias("user_id")), i.g_accounts.select("account_id", F.concat(
            F.lit("p"), F.floor(F.col("id") / 2).cast("string")).alias("person_id"))), "entity,id,label")
    add("derived_units", lambda i: e.derived_units(i.g_products), "product_id,unit_id,unit,price,currency")
    add("derived_pipelines", lambda i: e.derived_pipelines(i.deal_rows, i.account_orgs), "src,kind,dst")
    add("confidence_gate", lambda i: g.confidence_gate(i.instances, i.taxonomy), "entity,id,confidence:d,required:d,passed")
    add("validate_entities", lambda i: g.validate_entities(i.g_accounts, "Account", "id", [
        ("has_name", "name <> ''", 0.9), ("has_email", "email LIKE '%@%'", 0.6)]),
        "result_id,entity,instance_id,rule_id,check_passed,needs_review,confidence:d")
    add("governance_chain", lambda i: g.governance_chain(i.t_taxonomy, i.t_subtypes, i.t_entities, i.t_rules),
        "taxonomy,gate,subtype,entity,rule_id,predicate")
    add("contexts", lambda i: g.contexts(i.g_accounts, i.account_orgs, i.g_orgs, i.g_stores), "context_id,context_type,name,role_name")
    add("roles", lambda i: g.roles(i.g_accounts), "account_id,role")
    add("scopes", lambda i: g.scopes(i.g_accounts, i.g_groups, i.g_orgs, i.g_stores), "scope_id,scope_type,parent_id")
    add("policies", lambda i: g.policies(i.policy_rows), "policy_id,permission_id,permission,effect,scope_id")
    add("permission_overrides", lambda i: g.overrides(i.override_rows), "policy_id,permission_id,permission,effect,scope_id,role,account_scope")
    add("capabilities", lambda i: g.capabilities(i.feature_packages), "capability_id,name")
    add("enabled_capabilities", lambda i: g.enabled_capabilities(i.feature_plans, g.capabilities(i.feature_packages), i.account_orgs),
        "owner_kind,owner_id,capability_id")
    add("resolved_permissions", lambda i: g.resolved_permissions(
        g.scopes(i.g_accounts, i.g_groups, i.g_orgs, i.g_stores), g.policies(i.policy_rows), g.overrides(i.override_rows), g.roles(i.g_accounts)),
        "scope_id,permission,effect,distance:i,policy_id,is_override")
    add("effective_permissions", lambda i: g.effective_permissions(g.scopes(i.g_accounts, i.g_groups, i.g_orgs, i.g_stores), i.own_rules),
        "scope_id,permission,effect")
    add("provenance_touches", lambda i: p.provenance_touches({
        "page_visit": i.events.where("event_type = 'view'").select(F.col("event_id").alias("id"), F.lit("web").alias("channel"), F.col("ts").alias("at")),
        "rfq": i.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("channel"), F.col("o_orderdate").alias("at")),
        "lead": i.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("channel"), F.lit("2024-01-02").cast("timestamp").alias("at")),
        "thread": i.part.select(F.col("p_partkey").alias("id"), F.lit(None).cast("string").alias("channel"), F.lit("2024-01-03").cast("timestamp").alias("at"))}),
        "kind,source_ref,source_id,event_id,touch_id,signal_id,event_type,channel,touch_score:d,signal_weight:d,event_at")
    add("ip_identities", lambda i: p.ip_identities(i.sessions.withColumnRenamed("created_at", "last_activity"),
        i.ip_visits.withColumn("seen_at", F.lit(None).cast("timestamp"))), "ip_id,ip,source,last_seen")
    add("session_addresses", lambda i: p.session_addresses(i.sessions), "session_id,ip_id")
    add("device_identity", ghosts, "session_id,visitor_id,ip_id,fingerprint_id,profile_id,confidence:d")
    add("ghost_to_lead", lambda i: p.ghost_to_lead(ghosts(i), i.ip_visits.select("session_id", "page_view_id"), i.view_sources, i.lead_sources),
        "profile_id,lead_id")
    add("account_intent", intents, "intent_id,account_id,page_views:i,rfqs:i,deals:i,intent_type,score:d")
    add("intent_signals", lambda i: n.intent_signals(intents(i), i.l_views, i.l_rfqs, i.l_deals), "intent_id,signal_id,signal_type,weight:d")
    add("lead_prediction", lambda i: n.lead_prediction(i.lead_ids, rfqs=link(i, "a"), deals=link(i, "b"), threads=link(i, "c"),
                                                       sources=link(i, "d"), touches=link(i, "a")),
        "lead_id,rfqs:i,deals:i,threads:i,sources:i,touches:i,score:d,evidence_count:i,truth_confidence:d")
    add("org_evidence", lambda i: n.org_evidence(as_org(i.lead_ids), *[as_org(link(i, c)) for c in "abcd"]),
        "org_id,sells:i,facilities:i,supplied:i,target_views:i,evidence_count:i,confidence:d,source_depth:i")
    add("competitor_brands", lambda i: n.competitor_brands(i.g_stores, sold(i), i.g_products.select("product_id", "brand")),
        "competitor_id,org_id,brand,evidence_score:i")
    add("interest_findings", lambda i: n.interest_findings(i.seen_views), "finding_id,product_id:i,seller_id:i,finding_type,score:d")
    add("buyer_committees", lambda i: n.buyer_committees(
        i.ll.select("lead_id", F.col("a").cast("string").alias("id")), link(i, "b"), link(i, "d"), i.account_orgs),
        "committee_id,lead_id,size:i,threads:i,meetings:i,confidence:d,org_id")
    add("deal_prediction", lambda i: n.deal_prediction(
        i.deal_rows, i.deal_rows.select("deal_id", F.col("stage_id").alias("id")), i.deal_rows.select("deal_id", F.col("deal_id").alias("id")),
        i.lineitem.select(F.col("l_orderkey").alias("deal_id"), F.col("l_linenumber").alias("id"))),
        "deal_id,stages:i,legs:i,amount:d,escrow_status,score:d")
    add("lead_waterfall", lambda i: n.lead_waterfall(i.lead_ids, *[link(i, c) for c in "abcd"]),
        "lead_id,source_depth:i,rfqs:i,deals:i,threads:i,evidence_count:i")
    add("next_best_action", lambda i: n.next_best_action(i.lead_ids, link(i, "d"), link(i, "b"), link(i, "c"), link(i, "a")),
        "dispatcher_id,priority,action")
