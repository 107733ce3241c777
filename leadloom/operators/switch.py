"""Supplier-switch opportunities, alternative suppliers and the leads made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.config import Models
from leadloom.functions.ids import bucket_of, stable_id
from leadloom.functions.rank import best_row, top_k
from leadloom.functions.values import as_ts, choose, norm, tidy_round
from leadloom.operators.enrich import contains_pairs
from leadloom.operators.health import days_silent
from leadloom.session import staged

AT_RISK = ("stressed", "dormant", "churned")
# Points of the supplier ranking and where they apply.
POINTS_EXACT, POINTS_CHAPTER, POINTS_COUNTRY, POINTS_CONTACT = 40.0, 20.0, 15.0, 10.0
TOP_SUPPLIERS = 5

FEATURES = (
    "relationship_age_months", "total_shipments", "baseline_avg_qty", "last_shipment_date_days_ago",
    "qty_trend_3m", "qty_trend_6m", "shipment_regularity", "months_with_zero_shipments",
    "buyer_total_supplier_count", "buyer_employee_count", "buyer_industry_encoded",
    "buyer_intent_signal_count", "buyer_has_leadership_change", "buyer_has_funding_event",
    "buyer_has_ma_event", "supplier_active_buyer_count", "supplier_recent_export_volume",
    "hs_code_market_supplier_count", "anomaly_score",
)


def opportunities_from_rules(rules: DataFrame, as_of) -> DataFrame:
    """One open opportunity per relationship the rules call stressed, dormant or churned."""
    return rules.where(F.col("rule_status").isin(*AT_RISK)).select(
        stable_id(F.col("buyer_id"), F.col("supplier_id"), F.col("hs_code"), F.lit("rule_opp")).alias("opportunity_id"),
        "rel_id", "buyer_id", "buyer_name", F.col("supplier_id").alias("existing_supplier_id"),
        F.col("supplier_name").alias("existing_supplier_name"), "hs_code",
        F.col("rule_reason").alias("stress_reason"), F.col("rule_score").alias("stress_score"),
        F.coalesce("baseline_avg_qty", F.lit(0.0)).alias("buyer_monthly_volume"),
        F.lit("rule_based").alias("detection_method"), F.lit("open").alias("status"),
        as_ts(as_of).alias("first_detected_at"))


def opportunities_from_model(health: DataFrame, rels: DataFrame, as_of) -> DataFrame:
    """The same from model health (``stress_reason`` already added); stress = 100 - health."""
    keyed = rels.select("rel_id", "buyer_id", "buyer_name", "supplier_id", "supplier_name", "hs_code",
                        "baseline_avg_qty")
    return health.where(F.col("health_status").isin(*AT_RISK)).join(keyed, "rel_id").select(
        stable_id(F.col("buyer_id"), F.col("supplier_id"), F.col("hs_code"), F.lit("opp")).alias("opportunity_id"),
        "rel_id", "buyer_id", "buyer_name", F.col("supplier_id").alias("existing_supplier_id"),
        F.col("supplier_name").alias("existing_supplier_name"), "hs_code", "stress_reason",
        tidy_round(100 - F.col("health_score"), 1).alias("stress_score"),
        F.coalesce("baseline_avg_qty", F.lit(0.0)).alias("buyer_monthly_volume"),
        F.lit("ml_based").alias("detection_method"), F.lit("open").alias("status"),
        as_ts(as_of).alias("first_detected_at"))


def supplier_activity(rels: DataFrame, snapshots: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Per supplier: distinct buyers with months since ``as_of - days``, their volume, last month."""
    since = F.date_sub(as_ts(as_of).cast("date"), days)
    recent = snapshots.where(F.col("year_month") >= since).groupBy("rel_id").agg(
        F.sum(F.coalesce("total_quantity", F.lit(0.0))).alias("vol"), F.max("year_month").alias("last"))
    per_buyer = rels.select("rel_id", "supplier_id", "buyer_id").join(recent, "rel_id").groupBy(
        "supplier_id", "buyer_id").agg(F.sum("vol").alias("vol"), F.max("last").alias("last"))
    return per_buyer.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("active_buyers"), F.sum("vol").alias("recent_vol"), F.max("last").alias("last_export"))


def relationship_features(rels: DataFrame, snapshots: DataFrame, firms: DataFrame, anomalies: DataFrame,
                          as_of) -> DataFrame:
    """The 19 model inputs of every relationship (``FEATURES``) beside its keys.

    ``firms`` is keyed by org_id. Every count is aggregated to its own key first and joined on
    it, so nothing multiplies.
    """
    today = as_ts(as_of).cast("date")
    recent6 = snapshots.where(F.col("year_month") >= F.add_months(today, -6))
    in3 = F.col("year_month") >= F.add_months(today, -3)
    qty = F.coalesce("total_quantity", F.lit(0.0))
    months = recent6.groupBy("rel_id").agg(
        F.avg(qty).alias("avg6"), F.avg(F.when(in3, qty)).alias("avg3"), F.stddev_samp(qty).alias("sd6"),
        F.count(F.lit(1)).alias("n6"), F.sum((qty == 0).cast("long")).alias("zero6"))
    # Two-level distinct counts: (key, supplier) collapses map-side, then one count per key.
    pairs = rels.groupBy("buyer_id", "hs_code", "supplier_id").agg(F.lit(1).alias("one"))
    per_buyer = pairs.groupBy("buyer_id", "hs_code").agg(F.count(F.lit(1)).alias("buyer_total_supplier_count"))
    per_code = rels.groupBy("hs_code", "supplier_id").agg(F.lit(1).alias("one")).groupBy("hs_code").agg(
        F.count(F.lit(1)).alias("hs_code_market_supplier_count"))
    active = supplier_activity(rels, snapshots, as_of)
    firm = firms.select(F.col("org_id").alias("buyer_id"), "employee_count", "industry", "intent_count",
                        "leadership_change", "funding_event", "ma_event")
    joined = (rels.select("rel_id", "buyer_id", "supplier_id", "hs_code", "relationship_age_months",
                          "total_shipments", "baseline_avg_qty", "last_shipment_date")
              .join(months, "rel_id", "left").join(anomalies.select("rel_id", "anomaly_score"), "rel_id", "left")
              .join(per_buyer, ["buyer_id", "hs_code"], "left").join(per_code, "hs_code", "left")
              .join(active, "supplier_id", "left").join(firm, "buyer_id", "left"))
    base = F.coalesce("baseline_avg_qty", F.lit(0.0))

    def ratio(avg: str) -> Column:
        return tidy_round(F.when(base > 0, F.coalesce(avg, F.lit(0.0)) / base).otherwise(0.0), 4)

    def whole(col: str) -> Column:
        return F.coalesce(F.col(col).cast("long"), F.lit(0).cast("long"))

    return joined.select(
        "rel_id", "buyer_id", "supplier_id", "hs_code", "relationship_age_months", "total_shipments",
        base.alias("baseline_avg_qty"),
        F.greatest(F.lit(0), days_silent(F.col("last_shipment_date"), as_of)).cast("long").alias("last_shipment_date_days_ago"),
        ratio("avg3").alias("qty_trend_3m"), ratio("avg6").alias("qty_trend_6m"),
        tidy_round(F.when((F.col("n6") >= 2) & (F.col("avg6") > 0), F.col("sd6") / F.col("avg6")).otherwise(0.0),
                4).alias("shipment_regularity"),
        (F.greatest(F.lit(0), 6 - whole("n6")) + whole("zero6")).alias("months_with_zero_shipments"),
        whole("buyer_total_supplier_count").alias("buyer_total_supplier_count"),
        whole("employee_count").alias("buyer_employee_count"),
        bucket_of("industry").alias("buyer_industry_encoded"),
        whole("intent_count").alias("buyer_intent_signal_count"),
        whole("leadership_change").alias("buyer_has_leadership_change"),
        whole("funding_event").alias("buyer_has_funding_event"),
        whole("ma_event").alias("buyer_has_ma_event"),
        whole("active_buyers").alias("supplier_active_buyer_count"),
        F.coalesce("recent_vol", F.lit(0.0)).alias("supplier_recent_export_volume"),
        whole("hs_code_market_supplier_count").alias("hs_code_market_supplier_count"),
        F.coalesce("anomaly_score", F.lit(0.0)).alias("anomaly_score"))


def score_opportunities(opps: DataFrame, model_scores: DataFrame | None = None, cfg: Models = Models()) -> DataFrame:
    """Adds switch_probability: the model's by rel_id where given, else ``min(.95, stress/100 * .8)``.

    Below the threshold the opportunity's status becomes filtered_low_probability.
    """
    rows = opps
    if model_scores is None:
        rows = rows.withColumn("probability", F.lit(None).cast("double"))
    else:
        rows = rows.join(model_scores.select("rel_id", "probability"), "rel_id", "left")
    p = F.coalesce("probability", F.least(F.lit(0.95), F.col("stress_score") / 100 * 0.8))
    keep = p >= cfg.switch_prob_threshold
    return rows.withColumn("switch_probability", F.when(keep, tidy_round(p, 4))).withColumn(
        "status", F.when(keep, F.col("status")).otherwise("filtered_low_probability")).drop("probability")


def candidate_suppliers(rels: DataFrame, snapshots: DataFrame, firms: DataFrame, people_at: DataFrame,
                        as_of) -> DataFrame:
    """One row per (product code, supplier) with the supplier's own ranking inputs.

    Linear in the relationships. What depends on the opportunity (exact code or same first four
    digits, buyer country, excluded supplier) is added by ``match_suppliers`` without listing all
    opportunity x supplier pairs.
    """
    today = as_ts(as_of).cast("date")
    since = F.date_sub(today, 90)
    recent = snapshots.where(F.col("year_month") >= since).groupBy("rel_id").agg(
        F.sum(F.coalesce("total_quantity", F.lit(0.0))).alias("vol"), F.max("year_month").alias("last"))
    per_buyer = rels.where(F.col("supplier_id").isNotNull()).join(recent, "rel_id", "left").groupBy(
        "supplier_id", "buyer_id").agg(F.sum("vol").alias("vol"), F.max("last").alias("last"),
                                       F.min("supplier_name").alias("name"))
    profile = per_buyer.groupBy("supplier_id").agg(
        F.min("name").alias("supplier_name"), F.count("buyer_id").alias("active_buyer_count"),
        F.coalesce(F.sum("vol"), F.lit(0.0)).alias("recent_export_volume"), F.max("last").alias("last"))
    staff = firms.select(F.col("org_id").alias("supplier_id"), "employee_count")
    contact = people_at.select(F.col("org_id").alias("supplier_id")).distinct().withColumn("has_contact", F.lit(1))
    recency = F.greatest(F.lit(0), days_silent(F.col("last"), as_of)).cast("long")
    profile = profile.join(staff, "supplier_id", "left").join(contact, "supplier_id", "left").select(
        "supplier_id", "supplier_name", "active_buyer_count", "recent_export_volume",
        F.coalesce("employee_count", F.lit(0)).cast("long").alias("employee_count"),
        F.coalesce("has_contact", F.lit(0)).cast("long").alias("has_contact"), recency.alias("export_recency_days"))
    codes = rels.groupBy("hs_code", "supplier_id").agg(F.lit(1).alias("one")).drop("one")
    return codes.join(profile, "supplier_id").withColumn("hs_prefix", F.substring("hs_code", 1, 4)).withColumn(
        "own_points", own_points())


def own_points() -> Column:
    """Ranking points that do not depend on the opportunity."""
    return tidy_round(3.0 * F.least(F.col("active_buyer_count"), F.lit(10)) + POINTS_CONTACT * F.col("has_contact")
                   + 2.0 * F.greatest(F.lit(0.0), 7 - F.col("export_recency_days") / 30), 6)


def rank_heuristic(candidates: DataFrame) -> DataFrame:
    """Ranking points of given (opportunity, supplier) rows: exact, chapter, country and own points."""
    return candidates.withColumn("raw_score", POINTS_EXACT * F.col("hs_exact_match") + POINTS_CHAPTER * F.col(
        "hs_chapter_match") + POINTS_COUNTRY * F.col("exports_to_buyer_country") + own_points())


def match_suppliers(opps: DataFrame, candidates: DataFrame, rels: DataFrame, countries: DataFrame,
                    cfg: Models = Models()) -> DataFrame:
    """The best five other suppliers per open opportunity, score scaled 0..100 over all candidates.

    ``countries`` maps buyer_id to country. All opportunity x supplier pairs would be quadratic in
    a hot code, so two facts are used. (1) Points = own points + fixed bonuses, so the top five
    of an opportunity lie in the top six (one may be the excluded supplier) of four lists: per
    code, per 4-digit prefix, and both again within the buyer's country. (2) Own points take few
    distinct values, so the lowest score over all candidates comes out of per-value counts of the
    same four groups by inclusion and exclusion. Both steps are linear in the relationships. The
    small tables that several branches read (asked, demand, reach) are written once.
    """
    k = TOP_SUPPLIERS + 1
    place = countries.select("buyer_id", norm("country").alias("country")).where("country <> ''").distinct()
    asked = opps.where((F.col("status") == "open") & (F.col("switch_probability") >= cfg.switch_prob_threshold))
    asked = asked.select("opportunity_id", "buyer_id", "existing_supplier_id", "hs_code").join(
        place, "buyer_id", "left").select(
        "opportunity_id", "existing_supplier_id", "hs_code", F.substring("hs_code", 1, 4).alias("hs_prefix"),
        F.coalesce("country", F.lit("")).alias("country"))
    asked = staged(asked, "asked")
    demand = staged(asked.groupBy("hs_code", "hs_prefix", "country").agg(F.lit(1).alias("one")).drop("one"), "demand")

    # Which supplier ships to which asked country ("holds the name", as text).
    shipped = rels.select("supplier_id", "buyer_id").distinct().join(place, "buyer_id").select(
        "supplier_id", F.col("country").alias("long_text")).distinct()
    same = contains_pairs(place, "country", demand.where("country <> ''"), "country")
    reach = staged(shipped.join(same, "long_text").select(
        "supplier_id", F.col("short_text").alias("country")).distinct(), "reach")

    by_code = candidates.select("hs_code", "supplier_id", "own_points")
    by_prefix = candidates.select("hs_prefix", "supplier_id", "own_points").distinct()
    code_country = by_code.join(reach, "supplier_id").join(
        demand.select("hs_code", "country"), ["hs_code", "country"], "left_semi")
    prefix_country = by_prefix.join(reach, "supplier_id").join(
        demand.select("hs_prefix", "country").distinct(), ["hs_prefix", "country"], "left_semi")
    order = [-F.col("own_points"), F.col("supplier_id")]

    def leaders(rows: DataFrame, keys: list[str], exact: float, country: float) -> DataFrame:
        best = top_k(rows, keys, order, k).select(*keys, "supplier_id", (
            F.col("own_points") + (POINTS_CHAPTER + exact + country)).alias("raw_score"))
        return demand.join(best, keys).select("hs_code", "country", "supplier_id", "raw_score")

    lists = (leaders(by_code, ["hs_code"], POINTS_EXACT, 0.0)
             .unionByName(leaders(by_prefix, ["hs_prefix"], 0.0, 0.0))
             .unionByName(leaders(code_country, ["hs_code", "country"], POINTS_EXACT, POINTS_COUNTRY))
             .unionByName(leaders(prefix_country, ["hs_prefix", "country"], 0.0, POINTS_COUNTRY)))
    top = lists.groupBy("hs_code", "country", "supplier_id").agg(F.max("raw_score").alias("raw_score"))

    # Lowest two distinct scores over all candidates of (code, country), with the count of the lowest.
    def counted(rows: DataFrame, keys: list[str], parts: list[tuple[int, float]]) -> DataFrame:
        n = rows.groupBy(*keys, "own_points").agg(F.count(F.lit(1)).alias("n"))
        signed = F.explode(F.array(*[F.struct(
            (F.col("n") * sign).alias("n"), (F.col("own_points") + add).alias("score")) for sign, add in parts]))
        return demand.join(n, keys).select("hs_code", "country", signed.alias("s")).select(
            "hs_code", "country", "s.n", "s.score")

    chapter, exact = POINTS_CHAPTER, POINTS_CHAPTER + POINTS_EXACT
    histogram = (counted(by_prefix, ["hs_prefix"], [(1, chapter)])
                 .unionByName(counted(by_code, ["hs_code"], [(-1, chapter), (1, exact)]))
                 .unionByName(counted(prefix_country, ["hs_prefix", "country"],
                                      [(-1, chapter), (1, chapter + POINTS_COUNTRY)]))
                 .unionByName(counted(code_country, ["hs_code", "country"],
                                      [(1, chapter), (-1, exact), (-1, chapter + POINTS_COUNTRY),
                                       (1, exact + POINTS_COUNTRY)])))
    lowest = histogram.groupBy("hs_code", "country", "score").agg(F.sum("n").alias("n")).where("n > 0")
    lowest = lowest.groupBy("hs_code", "country").agg(F.min(F.struct("score", "n")).alias("a"), F.collect_set(
        F.struct("score", "n")).alias("all"))
    lowest = lowest.select("hs_code", "country", "a", F.try_element_at(
        F.array_sort("all"), F.lit(2)).alias("b"))

    # The excluded supplier's own score decides whether the lowest is still there without it.
    own = asked.join(by_code.withColumnRenamed("supplier_id", "existing_supplier_id"),
                     ["hs_code", "existing_supplier_id"], "left")
    own = own.join(reach.select(F.col("supplier_id").alias("existing_supplier_id"), "country",
                                F.lit(POINTS_COUNTRY).alias("bonus")), ["existing_supplier_id", "country"], "left")
    own = own.withColumn("own_score", F.col("own_points") + (
        F.coalesce("bonus", F.lit(0.0)) + exact)).drop("own_points", "bonus")
    bounds = own.join(lowest, ["hs_code", "country"]).withColumn("low", F.when(
        (F.col("own_score") == F.col("a.score")) & (F.col("a.n") == 1), F.col("b.score")).otherwise(F.col("a.score")))
    rows = bounds.select("opportunity_id", "existing_supplier_id", "hs_code", "country", "low").join(
        top, ["hs_code", "country"]).where(F.col("supplier_id") != F.col("existing_supplier_id"))
    # At most 4 * 6 rows per opportunity from here on.
    per_opp = Window.partitionBy("opportunity_id")
    rows = rows.withColumn("high", F.max("raw_score").over(per_opp)).withColumn(
        "rank", F.row_number().over(per_opp.orderBy(F.desc("raw_score"), "supplier_id")))
    span = F.col("high") - F.col("low")
    score = F.when(span < 1e-9, 50.0).otherwise((F.col("raw_score") - F.col("low")) / span * 100)
    kept = rows.withColumn("score", score).where(
        (F.col("rank") <= TOP_SUPPLIERS) & ((F.col("rank") == 1) | (F.col("score") >= cfg.match_score_threshold)))
    facts = candidates.select("supplier_id", "supplier_name", "active_buyer_count", "has_contact").distinct()
    exact_pairs = by_code.select("hs_code", "supplier_id", F.lit(True).alias("is_exact"))
    to_country = reach.withColumn("ships_there", F.lit(True))
    return (kept.join(facts, "supplier_id").join(exact_pairs, ["hs_code", "supplier_id"], "left")
            .join(to_country, ["supplier_id", "country"], "left").select(
        stable_id("opportunity_id", "supplier_id").alias("match_id"), "opportunity_id",
        F.col("supplier_id").alias("candidate_supplier_id"), F.col("supplier_name").alias("candidate_supplier_name"),
        F.when(F.coalesce("is_exact", F.lit(False)), "exact").otherwise("chapter").alias("hs_code_match_type"),
        tidy_round("score", 1).alias("match_score"), F.col("rank").cast("long").alias("rank"), "active_buyer_count",
        F.coalesce("ships_there", F.lit(False)).alias("exports_to_buyer_country"),
        (F.col("has_contact") > 0).alias("has_contact")))


def _clean_code(code: Column) -> Column:
    return F.regexp_replace(F.coalesce(code, F.lit("")), r"[\[\]\s]", "")


def _volume_text(volume: Column) -> Column:
    return F.when(volume > 0, F.format_string("~%,d units/month", F.floor(volume).cast("long"))).otherwise("unknown volume")


def _percent(p: Column) -> Column:
    return F.concat(tidy_round(p * 100, 0).cast("int").cast("string"), F.lit("%"))


def decision_maker_of(people: DataFrame, links: DataFrame) -> DataFrame:
    """One decision maker per organisation: the first by person key."""
    makers = people.where("is_decision_maker").join(links, "person_key")
    return makers.groupBy("org_id").agg(F.min(F.struct("person_key", "name", "title", "email")).alias("m")).select(
        F.col("org_id").alias("buyer_id"), F.col("m.name").alias("contact_name"),
        F.col("m.title").alias("contact_title"), F.col("m.email").alias("contact_email"))


LEAD_COLUMNS = ("lead_id", "opportunity_id", "match_id", "buyer_id", "buyer_name", "candidate_supplier_id",
                "candidate_supplier_name", "hs_code", "stress_reason", "switch_probability", "match_score",
                "final_lead_score", "lead_priority", "buyer_monthly_volume", "recommended_action",
                "contact_name", "contact_title", "contact_email", "status")


def switch_leads_matched(opps: DataFrame, matches: DataFrame, buyer_contacts: DataFrame,
                         cfg: Models = Models()) -> DataFrame:
    """One lead per opportunity and good match, with score, priority and a sentence for the seller."""
    live = opps.where((F.col("status") == "open") & (F.col("switch_probability") >= cfg.switch_prob_threshold))
    rows = matches.where(F.col("match_score") >= cfg.match_score_threshold).join(
        live.drop("status"), "opportunity_id").join(buyer_contacts, "buyer_id", "left")
    p, volume = F.col("switch_probability"), F.col("buyer_monthly_volume")
    final = tidy_round(F.least(F.lit(100.0), p * 40 + F.col("match_score") * 0.35
                            + F.least(volume / 10000, F.lit(25.0))), 1)
    rows = rows.withColumn("final_lead_score", final)
    score = F.col("final_lead_score")
    name = F.coalesce(F.nullif("buyer_name", F.lit("")), F.lit("Unknown Buyer"))
    current = F.coalesce(F.nullif("existing_supplier_name", F.lit("")), F.lit("current supplier"))
    contact = F.when(F.coalesce("contact_name", F.lit("")) != "", F.concat(
        "contact_name", F.lit(" ("), F.coalesce("contact_title", F.lit("")), F.lit(")"))).otherwise(
        "find via contact search")
    sentence = F.concat(
        F.lit("Buyer: "), name, F.lit(" imports "), _clean_code(F.col("hs_code")), F.lit(" ("), _volume_text(volume),
        F.lit(") from "), current, F.lit(". Relationship showing "), F.replace("stress_reason", F.lit("_"), F.lit(" ")),
        F.lit(". Switch probability: "), _percent(p), F.lit(". Contact: "), contact, F.lit("."),
        F.when(F.col("exports_to_buyer_country"), " Already ships to buyer country.").otherwise(""),
        F.when(F.col("active_buyer_count") > 0, F.concat(
            F.lit(" "), F.col("active_buyer_count").cast("string"), F.lit(" active buyers."))).otherwise(""))
    return rows.withColumns({
        "lead_id": stable_id(F.col("match_id"), F.lit("switch_lead")), "buyer_name": name,
        "lead_priority": choose([(score >= 80, "critical"), (score >= 65, "high"), (score >= 50, "medium")], "low"),
        "recommended_action": sentence, "status": F.lit("new"),
        **{c: F.coalesce(c, F.lit("")) for c in ("contact_name", "contact_title", "contact_email")},
    }).select(*LEAD_COLUMNS)


def switch_leads_unmatched(opps: DataFrame, matches: DataFrame, health: DataFrame, buyer_contacts: DataFrame,
                           cfg: Models = Models()) -> DataFrame:
    """Leads for dormant or churned relationships nobody was matched to: a supplier must be found."""
    live = opps.where((F.col("status") == "open") & (F.col("switch_probability") >= cfg.switch_prob_threshold))
    down = health.where(F.col("health_status").isin("dormant", "churned")).select(
        "rel_id", "health_status", F.coalesce("health_score", F.lit(0.0)).alias("health_score"))
    rows = live.join(matches.select("opportunity_id").distinct(), "opportunity_id", "left_anti").join(
        down, "rel_id").join(buyer_contacts, "buyer_id", "left")
    p, volume, h = F.col("switch_probability"), F.col("buyer_monthly_volume"), F.col("health_score")
    final = tidy_round(F.least(F.lit(100.0), p * 40 + F.least(volume / 10000, F.lit(25.0))
                            + F.greatest(F.lit(0.0), (100 - h) * 0.35)), 1)
    name = F.coalesce(F.nullif("buyer_name", F.lit("")), F.lit("Unknown Buyer"))
    current = F.coalesce(F.nullif("existing_supplier_name", F.lit("")), F.lit("current supplier"))
    sentence = F.concat(
        F.lit("URGENT - Relationship "), F.upper("health_status"), F.lit(": "), name, F.lit(" imports "),
        _clean_code(F.col("hs_code")), F.lit(" ("), _volume_text(volume), F.lit(") from "), current,
        F.lit(". Relationship showing "), F.replace("stress_reason", F.lit("_"), F.lit(" ")),
        F.lit(" (health score: "), tidy_round(h, 0).cast("int").cast("string"), F.lit("/100). "),
        F.lit("No alternative supplier matched yet; look for one in the market. Switch probability: "),
        _percent(p), F.lit("."))
    return rows.withColumn("final_lead_score", final).withColumns({
        "lead_id": stable_id(F.col("opportunity_id"), F.lit("unmatched_lead")), "buyer_name": name,
        "match_id": F.lit(""), "candidate_supplier_id": F.lit(""), "candidate_supplier_name": F.lit("[Sourcing Needed]"),
        "match_score": F.lit(0.0), "recommended_action": sentence, "status": F.lit("sourcing_needed"),
        "lead_priority": F.when((F.col("final_lead_score") >= 80) | (h <= 10), "critical").otherwise("high"),
        **{c: F.coalesce(c, F.lit("")) for c in ("contact_name", "contact_title", "contact_email")},
    }).select(*LEAD_COLUMNS)
