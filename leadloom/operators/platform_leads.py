"""Typed leads out of platform tables: one rule set per source, each source row at most once.

Every operator returns the leads to add: it leaves out what ``known`` (frame with source_ref)
already holds. lead_uid is ``classified:<type>:<source_ref>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.config import SourcePrefixes
from leadloom.functions.values import as_ts, choose, days_before, lookup, non_empty, norm, text

# Score and visibility by lead type, and the playbook tags.
SCORES = {
    "rfq_submitted": 85, "rfq_draft": 65, "quote_ready": 90, "engaged_person": 75, "engaged_account": 70,
    "known_account_interest": 68, "hot_in_market": 72, "intent_only": 55, "active_importer": 60, "visit_only": 40,
    "anonymous_account_visit": 30, "trade_buyer_candidate": 62, "strategic_account_watch": 65,
    "competitor_displacement": 80, "known_person_interest": 70, "reactivation_candidate": 72,
    "partner_chain_opportunity": 68, "suppressed_noise": 10, "active_exporter": 60,
}
VISIBILITY = {
    "rfq_submitted": "instant_alert", "quote_ready": "instant_alert", "hot_in_market": "instant_alert",
    "rfq_draft": "push_notify", "competitor_displacement": "push_notify", "switch_lead": "push_notify",
    "engaged_person": "priority", "engaged_account": "priority", "active_importer": "priority",
    "trade_buyer_candidate": "priority", "known_account_interest": "feed", "known_person_interest": "feed",
    "intent_only": "feed", "strategic_account_watch": "watchlist", "anonymous_account_visit": "watchlist",
    "visit_only": "count_only", "reactivation_candidate": "push_notify", "partner_chain_opportunity": "feed",
    "suppressed_noise": "count_only", "active_exporter": "feed",
}
PLAYBOOK_TAGS = {
    "rfq_submitted": ["rfq_respond_now", "procurement_response"],
    "quote_ready": ["rfq_respond_now", "commercial_path"],
    "hot_in_market": ["high_intent_abandonment", "account_warming"],
    "competitor_displacement": ["champion_reengagement", "commercial_path"],
    "engaged_person": ["contact_qualification", "buying_committee_velocity"],
    "engaged_account": ["account_warming", "contact_qualification"],
    "known_person_interest": ["contact_qualification", "outbound_trade"],
    "known_account_interest": ["account_warming"],
    "active_importer": ["outbound_trade", "procurement_response"],
    "trade_buyer_candidate": ["supply_chain_resilience", "outbound_trade"],
    "intent_only": ["account_warming", "high_intent_abandonment"],
    "strategic_account_watch": ["strategic_consolidation", "ecosystem_play"],
    "reactivation_candidate": ["champion_reengagement", "contact_moved_to_new_company"],
    "partner_chain_opportunity": ["ecosystem_play", "cross_sell"],
    "active_exporter": ["ecosystem_play", "strategic_consolidation"],
}
RFQ_SUBMITTED = ["processed", "processing", "health_check_process"]
RFQ_QUOTED = ["quoted", "approved", "closed_won"]
NOISE_TYPES = ["bot", "spam", "fake_rfq", "duplicate", "tracking_anomaly", "compliance_risk", "do_not_contact"]
PARTNER_WORDS = [("distribut", "distributor"), ("wholesale", "wholesaler"), ("resell", "reseller")]
PRODUCT_PAGE = "ProductDetail"
SHORT_KEYWORD = 40
STRATEGIC_VOLUME, STRATEGIC_SCORE, EXPORTER_RELATIONS = 10_000, 70, 3

COMMON = ("lead_uid", "lead_type", "score_final", "visibility_level", "source", "source_ref")


def _source(kind: str, prefix: str = SourcePrefixes().app) -> Column:
    return F.lit(f"{prefix}_{kind}")


def _leads(rows: DataFrame, known: DataFrame, kind: Column | str, ref: Column, source: Column, extra: Sequence[str] = (),
           score: Column | None = None, visibility: Column | None = None) -> DataFrame:
    """Common lead columns plus ``extra``; rows whose source_ref is known are dropped."""
    lead_type = F.lit(kind) if isinstance(kind, str) else kind
    made = rows.withColumns({"lead_type": lead_type, "source_ref": ref, "source": source})
    made = made.withColumns({
        "lead_uid": F.concat(F.lit("classified:"), F.col("lead_type"), F.lit(":"), F.col("source_ref")),
        "score_final": (lookup(SCORES, F.col("lead_type")) if score is None else score).cast("long"),
        "visibility_level": lookup(VISIBILITY, F.col("lead_type")) if visibility is None else visibility})
    return made.select(*COMMON, *extra).join(known.select("source_ref"), "source_ref", "left_anti").select(*COMMON, *extra)


def reclassify_untyped(leads: DataFrame, as_of) -> DataFrame:
    """Types for leads without one, from message and status; leads set by hand stay as they are."""
    open_row = F.col("lead_type").isNull() & ~F.coalesce("score_override", F.lit(False))
    kind = choose([(non_empty("message").isNotNull(), "known_account_interest"),
                   (F.col("status_id").isNotNull(), "engaged_account")], "known_person_interest")
    return leads.withColumns({
        "lead_type": F.when(open_row, kind).otherwise(F.col("lead_type")),
        "score_final": F.when(open_row, lookup(SCORES, kind)).otherwise(F.col("score_final")).cast("long"),
        "visibility_level": F.when(open_row, lookup(VISIBILITY, kind)).otherwise(F.col("visibility_level")),
        "classified_at": F.when(open_row, as_ts(as_of)).otherwise(F.col("classified_at"))})


def promote_cold_market(leads: DataFrame, as_of) -> DataFrame:
    """cold_market leads become active_importer leads; all others stay."""
    cold = F.col("lead_type") == "cold_market"
    return leads.withColumns({
        "score_final": F.when(cold, SCORES["active_importer"]).otherwise(F.col("score_final")).cast("long"),
        "visibility_level": F.when(cold, VISIBILITY["active_importer"]).otherwise(F.col("visibility_level")),
        "classified_at": F.when(cold, as_ts(as_of)).otherwise(F.col("classified_at")),
        "lead_type": F.when(cold, "active_importer").otherwise(F.col("lead_type"))})


def rfq_type(status: Column) -> Column:
    return choose([(status.isin(*RFQ_SUBMITTED), "rfq_submitted"), (status.isin(*RFQ_QUOTED), "quote_ready")], "rfq_draft")


def rfq_leads(rfqs: DataFrame, known: DataFrame) -> DataFrame:
    return _leads(rfqs.where("rfq_id is not null"), known, rfq_type(F.col("status")),
                  F.concat(F.lit("rfq:"), F.col("rfq_id").cast("string")), _source("crm"), ["rfq_id", "status"])


def meeting_leads(meetings: DataFrame, known: DataFrame) -> DataFrame:
    """A meeting on a lead engages the account; one without lead but with a host e-mail the person."""
    key = F.col("meeting_id").cast("string")
    account = _leads(meetings.where("lead_id is not null"), known, "engaged_account",
                     F.concat(F.lit("meeting:"), key), _source("crm"), ["meeting_id", "host_email"])
    person = _leads(meetings.where(F.col("lead_id").isNull() & non_empty("host_email").isNotNull()), known,
                    "engaged_person", F.concat(F.lit("meeting_person:"), key), _source("crm"), ["meeting_id", "host_email"])
    return account.unionByName(person)


def pageview_leads(views: DataFrame, known: DataFrame) -> DataFrame:
    """One visit lead per known account and session; 5 views or more lift score and visibility."""
    rows = views.where(non_empty("account_hint").isNotNull()).groupBy("account_hint", "session_key").agg(
        F.count(F.lit(1)).alias("pageview_count"), F.max("occurred_at").alias("last_seen"),
        F.min("occurred_at").alias("first_seen"))
    many = F.col("pageview_count") >= 5
    return _leads(rows, known, "visit_only", F.concat(F.lit("visit_only:sess:"), F.col("session_key")), _source("website"),
                  ["account_hint", "pageview_count", "first_seen", "last_seen"],
                  F.when(many, 50).otherwise(40), F.when(many, "priority").otherwise("count_only"))


def anonymous_leads(ghosts: DataFrame, known: DataFrame) -> DataFrame:
    return _leads(ghosts, known, "anonymous_account_visit", F.concat(F.lit("ghost:"), F.col("profile_id")),
                  _source("website"), ["profile_id", "confidence"])


def intent_leads(signals: DataFrame, known: DataFrame) -> DataFrame:
    """Per account: news triggers make it hot in market, third-party intent marks interest."""
    per = signals.where(non_empty("account_hint").isNotNull()).groupBy("account_hint").agg(
        F.count_if(F.col("signal_type") == "news_trigger_detected").alias("news"),
        F.max(F.when(F.col("signal_type") == "news_trigger_detected", F.col("occurred_at"))).alias("last_news"),
        F.count_if(F.col("signal_type") == "third_party_intent_detected").alias("intent"),
        F.max(F.when(F.col("signal_type") == "third_party_intent_detected", F.col("occurred_at"))).alias("last_intent"))
    hot = per.where("news > 0").select("account_hint", F.col("news").alias("trigger_count"), F.col("last_news").alias("last_seen"))
    soft = per.where("intent > 0").select("account_hint", F.lit(None).cast("long").alias("trigger_count"),
                                          F.col("last_intent").alias("last_seen"))
    extra = ["account_hint", "trigger_count", "last_seen"]
    return _leads(hot, known, "hot_in_market", F.concat(F.lit("hot_in_market:acct:"), F.col("account_hint")),
                  _source("intelligence"), extra).unionByName(
        _leads(soft, known, "intent_only", F.concat(F.lit("intent_only:acct:"), F.col("account_hint")),
               _source("intent"), extra))


def trade_buyer_leads(signals: DataFrame, known: DataFrame) -> DataFrame:
    """One candidate per account (or signal) with an importer signal."""
    keys = signals.where(F.col("signal_type") == "active_importer_detected").select(
        F.coalesce("account_hint", "signal_uid").alias("account_key")).where("account_key is not null").distinct()
    return _leads(keys, known, "trade_buyer_candidate", F.concat(F.lit("trade_buyer:"), F.col("account_key")),
                  _source("trade"), ["account_key"])


def engaged_person_leads(buyers: DataFrame, engagements: DataFrame, known: DataFrame) -> DataFrame:
    """Named buyers on leads (75) and people who worked with a product page (70)."""
    named = buyers.where(non_empty("first_name").isNotNull()).select(
        "id", F.trim(F.concat(text("first_name"), F.lit(" "), text("last_name"))).alias("contact_name"),
        text("email").alias("contact_email"), text("account_name").alias("company_name"),
        text("buyer_id").alias("buyer_user_id"), text("crm_lead_id").alias("crm_lead_id"))
    acted = engagements.where(F.col("user_id") > 0).select(
        "id", *[F.lit("").alias(c) for c in ("contact_name", "contact_email", "company_name")],
        text("user_id").alias("buyer_user_id"), text("lead_id").alias("crm_lead_id"))
    extra = ["contact_name", "contact_email", "company_name", "buyer_user_id", "crm_lead_id"]
    return _leads(named, known, "engaged_person", F.concat(F.lit("buyer_detail:"), F.col("id").cast("string")),
                  _source("crm"), extra).unionByName(
        _leads(acted, known, "engaged_person", F.concat(F.lit("lead_engagement:"), F.col("id").cast("string")),
               _source("crm"), extra, F.lit(70)))


def quotation_leads(quotations: DataFrame, known: DataFrame) -> DataFrame:
    rows = quotations.withColumns({"quotation_status": F.lower(text("status")),
                                   "product_name": text("product_name"),
                                   "total_cost": F.coalesce(F.col("total_cost").cast("double"), F.lit(0.0))})
    st = F.col("quotation_status")
    kind = F.when(st.isin("accepted", "sent"), "quote_ready").otherwise("rfq_submitted")
    score = choose([(st == "accepted", 95), (st == "sent", 85), (st.isin("initiated", "draft"), 75)], 70)
    return _leads(rows, known, kind, F.concat(F.lit("quotation:"), F.col("id").cast("string")), _source("crm"),
                  ["product_name", "total_cost", "quotation_status"], score, F.lit("instant_alert"))


def enquiry_type(raw: Column) -> tuple[Column, Column]:
    """Lead type and score of an enquiry type text."""
    e = norm(F.coalesce(raw, F.lit("")))
    return (choose([(e == "quote", "quote_ready"), (e == "seller created", "engaged_account")], "rfq_submitted"),
            choose([(e == "quote", 90), (e == "bid", 88), (e == "seller created", 70)], 85))


def enquiry_leads(enquiries: DataFrame, known: DataFrame) -> DataFrame:
    kind, score = enquiry_type(F.col("enquiry_type"))
    rows = enquiries.where("deleted_at is null").withColumns({
        "_kind": kind, "_score": score, "message": text("message"), "enquiry_type": norm(text("enquiry_type")),
        "buyer_user_id": text("enquiry_user_id"), "seller_user_id": text("seller_user_id"), "product_id": text("product_id"),
        "buyer_country": text("country"), "buyer_industry": text("industry"), "competitor": text("competitor")})
    return _leads(rows, known, F.col("_kind"), F.concat(F.lit("enquiry:"), F.col("id").cast("string")), _source("crm2"),
                  ["buyer_user_id", "seller_user_id", "product_id", "message", "buyer_country", "buyer_industry", "competitor",
                   "enquiry_type"], F.col("_score"))


def session_leads(views: DataFrame, sessions: DataFrame, known: DataFrame) -> DataFrame:
    """One lead per session with page views: a visit of a known user or an anonymous visit."""
    per_type = views.where("deleted_at is null").groupBy("session_id", "type").agg(
        F.count(F.lit(1)).alias("n"), F.max("created_at").alias("last"), F.min("created_at").alias("first"))
    per = per_type.groupBy("session_id").agg(
        F.sum("n").alias("pageview_count"), F.max("last").alias("last_seen"), F.min("first").alias("first_seen"),
        F.coalesce(F.sum(F.when(F.col("type") == PRODUCT_PAGE, F.col("n"))), F.lit(0)).alias("product_views"),
        F.array_join(F.array_sort(F.collect_list("type")), ",").alias("page_types"))
    rows = per.join(sessions.select("session_id", "user_id"), "session_id", "left").withColumn(
        "user_id", F.coalesce("user_id", F.lit(0)).cast("long"))
    is_known, busy = F.col("user_id") > 0, F.col("pageview_count") >= 3
    return _leads(
        rows, known, F.when(is_known, "visit_only").otherwise("anonymous_account_visit"),
        F.concat(F.lit("crm2_session:"), F.col("session_id")), _source("website_crm2"),
        ["session_id", "user_id", "pageview_count", "product_views", "page_types", "first_seen", "last_seen"],
        choose([(~is_known, 30), (busy | (F.col("product_views") >= 1), 50)], 40),
        choose([(~is_known, "watchlist"), (busy, "priority")], "count_only"))


def search_leads(searches: DataFrame, known: DataFrame) -> DataFrame:
    """One intent lead per user and keyword; every search counts 2 points, 20 at most.

    The reference key is the keyword up to ``SHORT_KEYWORD`` characters and its MD5 beyond, so keys stay short and no two
    keywords of a user share one. A null keyword counts as the empty one; of several categories the lowest is kept.
    """
    rows = searches.where("deleted_at is null and user_id > 0").groupBy("user_id", text("name").alias("keyword")).agg(
        F.sum("searched_total").alias("search_count"), F.max("created_at").alias("last_searched"),
        text(F.min("category_id")).alias("category_id"))
    key = F.when(F.length("keyword") <= SHORT_KEYWORD, F.col("keyword")).otherwise(F.concat(F.lit("md5:"), F.md5("keyword")))
    ref = F.concat(F.lit("search:"), F.col("user_id").cast("string"), F.lit(":"), key)
    return _leads(rows, known, "intent_only", ref, _source("search"),
                  ["user_id", "keyword", "category_id", "search_count", "last_searched"],
                  55 + F.least(F.coalesce("search_count", F.lit(0)) * 2, F.lit(20)))


def competitor_leads(enquiries: DataFrame, known: DataFrame) -> DataFrame:
    """Buyers who name the rival they buy from."""
    rows = enquiries.where(F.col("deleted_at").isNull() & (F.trim("competitor") != "")).withColumns({
        "current_supplier": F.col("competitor"), "message": text("message"), "buyer_user_id": text("enquiry_user_id"),
        "seller_user_id": text("seller_user_id"), "product_id": text("product_id"), "buyer_country": text("country"),
        "enquiry_type": F.lower(text("enquiry_type"))})
    return _leads(rows, known, "competitor_displacement",
                  F.concat(F.lit("competitor_enquiry:"), F.col("id").cast("string")), _source("crm2"),
                  ["buyer_user_id", "seller_user_id", "product_id", "current_supplier", "message", "buyer_country", "enquiry_type"])


def strategic_watch(rels: DataFrame, leads: DataFrame, switch_leads: DataFrame, known: DataFrame,
                    min_volume: float = STRATEGIC_VOLUME) -> DataFrame:
    """Large importers nobody works on yet: no strong lead and no switch lead, by id or by name.

    The OR of id and name is two anti joins each, not a nested-loop join.
    """
    per = rels.where(F.col("buyer_monthly_volume") >= min_volume).where(non_empty("buyer_name").isNotNull()).groupBy(
        F.col("buyer_id").alias("buyer_org_id"), F.col("buyer_name").alias("company_name")).agg(
        F.max("buyer_monthly_volume").alias("buyer_monthly_volume"), F.max("health_score").alias("trade_health_score"),
        F.count(F.lit(1)).alias("trade_relationship_count"))
    strong = leads.where(F.col("score_final") >= STRATEGIC_SCORE)
    for taken, by_id, by_name in ((strong, "buyer_org_id", "company_name"), (switch_leads, "buyer_id", "buyer_name")):
        ids = taken.select(F.col(by_id).alias("buyer_org_id")).where("buyer_org_id is not null").distinct()
        names = taken.select(F.col(by_name).alias("company_name")).where("company_name is not null").distinct()
        per = per.join(ids, "buyer_org_id", "left_anti").join(names, "company_name", "left_anti")
    return _leads(per, known, "strategic_account_watch",
                  F.concat(F.lit("strategic_watch:"), F.coalesce("buyer_org_id", "company_name")), _source("trade"),
                  ["company_name", "buyer_org_id", "buyer_monthly_volume", "trade_health_score", "trade_relationship_count"])


def reactivation_leads(deals: DataFrame, known: DataFrame, as_of) -> DataFrame:
    """Old deals (created over 90 days ago) touched in the last 30 days."""
    now = as_ts(as_of)
    rows = deals.where((F.col("updated_at") > days_before(now, 30)) & (F.col("created_at") < days_before(now, 90)))
    rows = rows.withColumn("deal_amount", F.coalesce(F.col("amount").cast("double"), F.lit(0.0)))
    return _leads(rows, known, "reactivation_candidate", F.concat(F.lit("deal:"), F.col("id").cast("string")),
                  _source("crm"), ["deal_amount"])


def partner_leads(enquiries: DataFrame, known: DataFrame) -> DataFrame:
    """Enquiries of resellers, wholesalers or distributors, by words in purpose or message."""
    words = F.lower(F.concat(text("purpose_of_inquiry"), F.lit("\n"), text("message")))
    kind = choose([(F.contains(words, F.lit(w)), name) for w, name in PARTNER_WORDS], None)
    rows = enquiries.where("deleted_at is null").withColumns({
        "partner_type": kind, "buyer_user_id": text("enquiry_user_id"), "buyer_country": text("country")})
    return _leads(rows.where("partner_type is not null"), known, "partner_chain_opportunity",
                  F.concat(F.lit("enquiry_partner:"), F.col("id").cast("string")), _source("crm2"),
                  ["partner_type", "buyer_user_id", "buyer_country"])


def noise_leads(flags: DataFrame, known: DataFrame) -> DataFrame:
    """Risk flags as suppressed leads sellers never see."""
    rows = flags.where(F.col("risk_type").isin(*NOISE_TYPES)).withColumns({
        "account_uid": text("account_uid"), "suppression_reason": F.col("risk_type"),
        "risk_severity": F.coalesce(non_empty("severity"), F.lit("medium")), "suppressed": F.lit(True),
        "seller_visible": F.lit(False), "distribution_status": F.lit("suppressed")})
    return _leads(rows, known, "suppressed_noise", F.concat(F.lit("risk_flag:"), F.col("id").cast("string")),
                  F.lit("crm_risk"), ["account_uid", "suppression_reason", "risk_severity", "suppressed",
                                      "seller_visible", "distribution_status"])


def exporter_leads(rels: DataFrame, sellers: DataFrame, known: DataFrame) -> DataFrame:
    """Suppliers with at least three relationships that do not sell on the platform, by id or name."""
    per = rels.where(non_empty("supplier_name").isNotNull()).groupBy(
        F.col("supplier_id").alias("buyer_org_id"), F.col("supplier_name").alias("company_name")).agg(
        F.count(F.lit(1)).alias("trade_relationship_count"), F.avg("health_score").alias("avg_trade_health"),
        F.sum("total_shipments").alias("total_shipments")).where(
        F.col("trade_relationship_count") >= EXPORTER_RELATIONS)
    ids = sellers.select(F.col("org_id").alias("buyer_org_id")).where("buyer_org_id is not null").distinct()
    names = sellers.select(F.col("name").alias("company_name")).where("company_name is not null").distinct()
    per = per.join(ids, "buyer_org_id", "left_anti").join(names, "company_name", "left_anti")
    return _leads(per, known, "active_exporter",
                  F.concat(F.lit("active_exporter:"), F.coalesce("buyer_org_id", "company_name")), _source("trade"),
                  ["company_name", "buyer_org_id", "trade_relationship_count", "avg_trade_health", "total_shipments"])


def playbook_tags(leads: DataFrame) -> DataFrame:
    """Tags by lead type where a lead has none yet (``playbook_tags`` array)."""
    spark = leads.sparkSession
    table = spark.createDataFrame(list(PLAYBOOK_TAGS.items()), "lead_type string, _tags array<string>")
    empty = F.col("playbook_tags").isNull() | (F.size("playbook_tags") == 0)
    return leads.join(F.broadcast(table), "lead_type", "left").withColumn(
        "playbook_tags", F.when(empty, F.col("_tags")).otherwise(F.col("playbook_tags"))).drop("_tags")


def lead_type_distribution(leads: DataFrame, switch_leads: DataFrame) -> DataFrame:
    """Number of leads per type, the switch leads, and the total."""
    counts = leads.groupBy("lead_type").agg(F.count(F.lit(1)).alias("leads")).unionByName(
        switch_leads.agg(F.count(F.lit(1)).alias("leads")).select(F.lit("switch_lead").alias("lead_type"), "leads"))
    return counts.unionByName(counts.agg(F.sum("leads").alias("leads")).select(F.lit("total").alias("lead_type"), "leads"))
