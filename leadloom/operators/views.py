"""The analytical questions asked of the results: lists with filters, statistics, dashboards.

Lists take ``top`` (a top-k report); pages are cut by a stable order with the key as tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.functions.rank import best_row, top_k
from leadloom.functions.values import as_ts, choose, days_before, lookup, norm, one_row, text, tidy_round
from leadloom.operators.enrich import any_word, contains_pairs

# Customs chapter names and title words of decision makers.
HS_CHAPTERS = {
    "01": "Live animals", "02": "Meat & edible offal", "03": "Fish & seafood", "04": "Dairy & eggs",
    "05": "Animal products", "06": "Live plants & flowers", "07": "Edible vegetables", "08": "Edible fruits & nuts",
    "09": "Coffee, tea & spices", "10": "Cereals", "11": "Milling products", "12": "Oil seeds", "13": "Lac & gums",
    "14": "Vegetable plaiting materials", "15": "Animal/vegetable fats & oils", "16": "Preparations of meat/fish",
    "17": "Sugars & confectionery", "18": "Cocoa & preparations", "19": "Cereal/flour/starch preparations",
    "20": "Preparations of vegetables/fruits", "21": "Miscellaneous food preparations",
    "22": "Beverages, spirits & vinegar", "23": "Residues & food industry waste", "24": "Tobacco",
    "25": "Salt, sulphur, earths & stone", "26": "Ores & slag", "27": "Mineral fuels & oils",
    "28": "Inorganic chemicals", "29": "Organic chemicals", "30": "Pharmaceutical products", "31": "Fertilisers",
    "32": "Tanning & dyeing extracts", "33": "Essential oils & cosmetics", "34": "Soap & waxes",
    "35": "Albuminoidal substances & enzymes", "36": "Explosives & pyrotechnics", "37": "Photographic goods",
    "38": "Miscellaneous chemical products", "39": "Plastics", "40": "Rubber", "41": "Raw hides & skins",
    "42": "Leather articles", "43": "Furskins", "44": "Wood & wood products", "45": "Cork",
    "46": "Straw & basketware", "47": "Pulp of wood", "48": "Paper & paperboard",
    "49": "Printed books & newspapers", "50": "Silk", "51": "Wool", "52": "Cotton",
    "53": "Other vegetable textile fibres", "54": "Man-made filaments", "55": "Man-made staple fibres",
    "56": "Wadding & felt", "57": "Carpets", "58": "Special woven fabrics", "59": "Impregnated textile fabrics",
    "60": "Knitted fabrics", "61": "Knitted apparel", "62": "Woven apparel", "63": "Other textile articles",
    "64": "Footwear", "65": "Headgear", "66": "Umbrellas", "67": "Feathers & artificial flowers",
    "68": "Stone & cement articles", "69": "Ceramic products", "70": "Glass", "71": "Precious stones & metals",
    "72": "Iron & steel", "73": "Iron/steel articles", "74": "Copper", "75": "Nickel", "76": "Aluminium",
    "78": "Lead", "79": "Zinc", "80": "Tin", "81": "Other base metals", "82": "Tools & cutlery",
    "83": "Miscellaneous metal articles", "84": "Machinery & mechanical appliances",
    "85": "Electrical machinery & equipment", "86": "Railway equipment", "87": "Vehicles", "88": "Aircraft",
    "89": "Ships & boats", "90": "Optical & medical instruments", "91": "Clocks & watches",
    "92": "Musical instruments", "93": "Arms & ammunition", "94": "Furniture & bedding", "95": "Toys & games",
    "96": "Miscellaneous manufactures", "97": "Works of art",
}
BUYING_TITLES = ["procurement", "purchasing", "supply chain", "sourcing", "supplier", "category manager", "buyer",
                 "head of supply", "vp supply", "director of supply", "chief supply", "chief procurement", "cpo",
                 "director of procurement", "vp procurement", "global procurement", "strategic sourcing",
                 "materials manager", "vendor management", "supply manager"]
STATUSES = ["churned", "dormant", "stressed", "irregular", "healthy"]
STEPS = [("respond_immediately", "Respond to RFQ within 2 hours"),
         ("proactive_outreach", "Send personalised outreach referencing trade data"),
         ("multi_stakeholder", "Map buying committee before outreach"),
         ("close_now", "Escalate to account executive for close"),
         ("consolidation", "Prepare consolidation proposal for executive sponsor")]
TIER_ORDER = {"enterprise": 1, "professional": 2}
PRIORITY_PLACE = {"critical": 1, "high": 2, "medium": 3}


def chapter_name(code: Column, default: Column) -> Column:
    return F.coalesce(lookup(HS_CHAPTERS, F.substring(F.regexp_replace(text(code), r"[\[\]\s]", ""), 1, 2)), default)


def _first(rows: DataFrame, order: list[Column], top: int | None) -> DataFrame:
    """The first rows of a report; all of them, sorted, without a limit."""
    ordered = rows.orderBy(*order)
    return ordered if top is None else ordered.limit(top)


def trade_view(rels: DataFrame, opps: DataFrame, min_volume: float = 0.0, status: str | None = None,
               country: str | None = None, top: int | None = None) -> DataFrame:
    """Relationships, largest first, with their number of opportunities; all of them unless ``top`` says how many."""
    rows = rels.where(F.col("buyer_monthly_volume") >= min_volume)
    if status:
        rows = rows.where(F.lower("health_status") == status.lower())
    if country:
        rows = rows.where(F.upper("buyer_country") == country.upper())
    best = _first(rows, [F.desc("buyer_monthly_volume"), F.col("rel_id")], top)
    counts = opps.join(best.select("rel_id"), "rel_id", "left_semi").groupBy("rel_id").agg(F.count(F.lit(1)).alias("opportunity_count"))
    return best.join(counts, "rel_id", "left").withColumn("opportunity_count", F.coalesce("opportunity_count", F.lit(0)))


def trade_stats(rels: DataFrame) -> DataFrame:
    v = F.col("buyer_monthly_volume")
    return rels.agg(
        F.count(F.lit(1)).alias("total_relationships"), tidy_round(F.sum(v), 2).alias("total_monthly_volume"),
        tidy_round(F.avg(v), 2).alias("avg_monthly_volume"), tidy_round(F.max(v), 2).alias("max_monthly_volume"),
        tidy_round(F.avg("health_score"), 1).alias("avg_health_score"),
        *[F.count_if(F.lower("health_status") == s).alias(s) for s in STATUSES])


def intent_band(score: Column) -> Column:
    return choose([(score >= 70, "high"), (score >= 50, "medium")], "low")


def profile_view(profiles: DataFrame, min_score: int = 0, has_enquiries: bool | None = None,
                 band: str | None = None, top: int | None = None) -> DataFrame:
    rows = profiles.where(F.col("behavioral_score") >= min_score)
    if has_enquiries is not None:
        rows = rows.where((F.coalesce("enquiries_sent", F.lit(0)) > 0) == F.lit(has_enquiries))
    if band:
        rows = rows.where(intent_band(F.col("behavioral_score")) == band)
    return _first(rows.withColumn("intent_band", intent_band(F.col("behavioral_score"))),
                  [F.desc("behavioral_score"), F.desc("enquiries_sent"), F.col("user_id")], top)


def profile_stats(profiles: DataFrame) -> DataFrame:
    s = F.col("behavioral_score")
    return profiles.agg(
        F.count(F.lit(1)).alias("total_profiles"), tidy_round(F.avg(s), 1).alias("avg_behavioral_score"),
        F.count_if(s >= 70).alias("high_intent"), F.count_if((s >= 50) & (s < 70)).alias("medium_intent"),
        F.count_if(s < 50).alias("low_intent"), F.count_if(F.col("enquiries_sent") > 0).alias("with_enquiries"),
        F.count_if(F.col("messages_sent") > 0).alias("chatted"), F.count_if(F.col("high_intent_score") >= 6).alias("strong_clickers"),
        F.count_if(F.col("max_scroll_depth") >= 75).alias("deep_readers"), F.sum("total_clicks").alias("platform_clicks"),
        F.sum("enquiries_sent").alias("total_enquiries"))


def opportunity_view(opps: DataFrame, health: DataFrame, method: str | None = None, top: int | None = None) -> DataFrame:
    """Opportunities on the least healthy relationships first."""
    rows = opps if method is None else opps.where(F.col("detection_method") == method)
    return _first(rows.join(health.select("rel_id", "health_score", "health_status"), "rel_id", "left"),
                  [F.asc_nulls_last("health_score"), F.desc_nulls_last("switch_probability"), F.col("opportunity_id")], top)


def detection_comparison(opps: DataFrame, health: DataFrame) -> DataFrame:
    """Per detection method: how many, mean health and probability, statuses."""
    rows = opps.join(health.select("rel_id", "health_score", "health_status"), "rel_id", "left")
    return rows.groupBy("detection_method").agg(
        F.count(F.lit(1)).alias("total"), tidy_round(F.avg("health_score"), 1).alias("avg_health_score"),
        tidy_round(F.avg("switch_probability") * 100, 1).alias("avg_switch_prob_pct"),
        *[F.count_if(F.col("health_status") == s).alias(s) for s in STATUSES[:3]])


def pipeline_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of rows of every result table."""
    out = None
    for label, frame in tables.items():
        part = frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias("label"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def pipeline_status(tables: dict[str, DataFrame], leads: DataFrame, opps: DataFrame) -> DataFrame:
    """What a run has left: (part, label, rows, latest_at): rows of every table, the latest lead, leads by type, opportunities by method."""
    nothing = F.lit(None).cast("timestamp").alias("latest_at")
    counts = pipeline_counts(tables).select(F.lit("table").alias("part"), "label", "rows", nothing)
    latest = leads.agg(F.max("classified_at").cast("timestamp").alias("latest_at")).select(
        F.lit("latest_lead").alias("part"), F.lit("Lead").alias("label"), F.lit(None).cast("long").alias("rows"), "latest_at")

    def broken_down(rows: DataFrame, by: str, part: str) -> DataFrame:
        return rows.groupBy(F.col(by).alias("label")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(part).alias("part"), "label", "rows", nothing)
    return counts.unionByName(latest).unionByName(broken_down(leads, "lead_type", "lead_type")).unionByName(
        broken_down(opps, "detection_method", "detection_method"))


def enriched_leads(switch_leads: DataFrame, opps: DataFrame, rels: DataFrame, as_of, min_score: float = 0.0,
                   best_per_buyer: bool = False, top: int | None = None) -> DataFrame:
    """Switch leads with the relationship behind them, chapter name, urgency and months since the last shipment."""
    rows = switch_leads.where(F.col("final_lead_score") >= min_score)
    if best_per_buyer:
        rows = best_row(rows.withColumn("_buyer", F.coalesce(F.nullif("buyer_id", F.lit("")), "buyer_name")), ["_buyer"],
                        [F.col("final_lead_score"), F.col("lead_id")]).drop("_buyer")
    opp = opps.select("opportunity_id", "rel_id", "stress_score", "existing_supplier_id", "existing_supplier_name")
    rel = rels.select("rel_id", "health_score", "health_status", "total_shipments", "last_shipment_date",
                      "relationship_age_months", "baseline_avg_qty")
    joined = rows.join(opp, "opportunity_id", "left").join(rel, "rel_id", "left")
    health = F.coalesce("health_score", "stress_score")
    p = F.coalesce("switch_probability", F.lit(0.0)) * 100
    code = F.regexp_replace(text("hs_code"), r"[\[\]\s]", "")
    out = joined.select(
        "lead_id", "buyer_id", "buyer_name", "existing_supplier_id", "existing_supplier_name", "candidate_supplier_name",
        code.alias("hs_code"), chapter_name(F.col("hs_code"), F.concat(F.lit("HS "), code)).alias("hs_description"),
        "final_lead_score", choose([((health < 40) | (p >= 60), "HIGH"), ((health < 70) | (p >= 35), "MEDIUM")],
                                   "LOW").alias("urgency"),
        health.alias("health_score"),
        F.coalesce(F.nullif("baseline_avg_qty", F.lit(0.0)), "buyer_monthly_volume", F.lit(0.0)).alias("monthly_volume"),
        F.coalesce("total_shipments", F.lit(0)).alias("total_shipments"),
        F.greatest(F.lit(0), F.floor(F.datediff(as_ts(as_of).cast("date"), "last_shipment_date") / 30)).alias("months_since_last"),
        (p >= 60).alias("act_within_two_weeks"), "recommended_action")
    return out if top is None else out.orderBy(F.desc("final_lead_score"), "lead_id").limit(top)


def decision_makers(companies: DataFrame, contacts: DataFrame, most: int = 5, fallback: int = 3) -> DataFrame:
    """Up to five buying-side contacts per company (contact company holds its name), else any first three."""
    pairs = contains_pairs(contacts, "company_name", companies, "company")
    rows = companies.select("company", F.lower("company").alias("short_text")).distinct().join(pairs, "short_text").join(
        contacts.withColumn("long_text", F.lower("company_name")), "long_text")
    rows = rows.withColumn("is_maker", any_word(text("title"), BUYING_TITLES)).select("company", "person_key", "title", "email", "is_maker")
    ranked = top_k(rows, ["company"], [(~F.col("is_maker")).cast("int"), F.col("person_key")], most)
    found = rows.groupBy("company").agg(F.max("is_maker").alias("any_maker"))
    return ranked.join(found, "company").where(F.when(F.col("any_maker"), F.col("is_maker")).otherwise(
        F.col("rank") <= fallback)).drop("any_maker")


def lead_summary(switch_leads: DataFrame, rels: DataFrame, opps: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return one_row([switch_leads.agg(n.alias("total_switch_leads")), rels.agg(n.alias("trade_relationships_monitored")),
                    opps.agg(n.alias("stressed_relationships"))])


def seller_dashboard(sellers: DataFrame, assignments: DataFrame, accounts: DataFrame, as_of) -> DataFrame:
    """One row per seller: assignments by status, new in 7 days, rates, credits."""
    week = days_before(as_ts(as_of), 7)
    counts = assignments.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("total_assigned"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("viewed", "contacted", "converted", "rejected")],
        F.count_if((F.col("status") == "assigned") & (F.col("assigned_at") >= week)).alias("new_last_7d"))
    rows = sellers.select("seller_id", "name", "tier").join(counts, "seller_id", "left").join(accounts.select(
        "seller_id", "credits_available", "credits_used_month", "credits_total_month"), "seller_id", "left").na.fill(0)
    total = F.greatest(F.col("total_assigned"), F.lit(1))
    month = F.col("credits_total_month")
    return rows.withColumns({
        "conversion_rate_pct": tidy_round(100.0 * F.col("converted") / total, 1),
        "contact_rate_pct": tidy_round(100.0 * F.col("contacted") / total, 1),
        "credits_unlimited": month == -1,
        "credits_used_pct": F.when(month > 0, tidy_round(100.0 * F.col("credits_used_month") / month, 1)).otherwise(0.0)})


def seller_performance(assignments: DataFrame, leads: DataFrame) -> DataFrame:
    """Per seller and lead type: assignments, conversions, rejections, rate, mean score."""
    rows = assignments.join(leads.select(F.col("lead_uid").alias("lead_id"), "lead_type", "score_final"), "lead_id")
    return rows.groupBy("seller_id", "lead_type").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "converted").alias("converted"),
        F.count_if(F.col("status") == "rejected").alias("rejected"), F.avg("score_final").alias("avg_score")).withColumn(
        "conv_rate_pct", tidy_round(100.0 * F.col("converted") / F.col("total"), 1))


def action_steps(tags: Column) -> Column:
    """Next steps for the tags of a lead."""
    found = F.filter(F.array(*[F.when(F.contains(tags, F.lit(t)), F.lit(s)) for t, s in STEPS]), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("Review profile and add to nurture sequence")))


def assigned_leads(assignments: DataFrame, leads: DataFrame, switch_leads: DataFrame, status: str | None = None,
                   page: int = 0, page_size: int | None = None) -> DataFrame:
    """Every seller's leads, both lead kinds, by priority and score; one page of them where ``page_size`` says how long it is."""
    ours = leads.select(F.col("lead_uid").alias("lead_id"), "lead_type", "priority", F.col("score_final").cast("double").alias("score"),
                        text("playbook_tags").alias("tags"), F.lit(None).cast("string").alias("action"), "hs_code")
    theirs = switch_leads.select("lead_id", F.lit("switch_lead").alias("lead_type"), F.col("lead_priority").alias("priority"),
                                 F.col("final_lead_score").alias("score"), F.lit("").alias("tags"),
                                 F.col("recommended_action").alias("action"), "hs_code")
    rows = assignments if status is None else assignments.where(F.col("status") == status)
    rows = rows.select("assignment_id", "seller_id", "lead_id", "status").join(ours.unionByName(theirs), "lead_id")
    place = lookup(PRIORITY_PLACE, F.col("priority"), 4)
    order = [place, -F.coalesce("score", F.lit(0.0)), F.col("assignment_id")]
    if page_size is None:
        ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("seller_id").orderBy(*order)))
    else:
        ranked = top_k(rows, ["seller_id"], order, (page + 1) * page_size).where(F.col("rank") > page * page_size)
    p, s = F.col("priority"), F.coalesce("score", F.lit(0.0))
    return ranked.withColumns({
        "hs_description": chapter_name(F.col("hs_code"), F.lit("Unknown")),
        "action_steps": F.when(text("action") != "", F.array("action")).otherwise(action_steps(F.col("tags"))),
        "urgency": choose([((p == "critical") | (s >= 85), "HIGH"), ((p == "high") | (s >= 70), "MEDIUM")], "LOW")})


def sellers_list(sellers: DataFrame, accounts: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "name", "tier", "active", "max_leads_per_day", "leads_today").join(
        accounts.select("seller_id", "credits_available"), "seller_id", "left").na.fill(0.0, ["credits_available"]).orderBy(
        lookup(TIER_ORDER, F.col("tier"), 3), "name", "seller_id")
