"""Per-user behaviour profiles and the leads and scores that follow from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.config import SourcePrefixes
from leadloom.functions.rank import top_k
from leadloom.functions.values import choose, lookup, non_empty, text
from leadloom.operators.platform_leads import PRODUCT_PAGE

# Purchase intent of page elements (by name) and of buttons (by id).
ELEMENT_WEIGHTS = {
    "Get Quote Now": 3, "Get Quote": 3, "Send a Query": 2, "Contact Supplier": 2, "Chat with Seller": 2,
    "Technical Specifications": 1, "Packaging Details": 1, "Certifications and Compliance": 1, "Company Profile": 1,
}
BUTTON_WEIGHTS = {
    "getQuoteButton": 3, "getquotebutton": 3, "contact-seller": 2, "contact_seller": 2, "send-query": 2,
    "Chat with Seller": 2, "add-to-contact": 2, "catalog-download": 2, "company-profile": 1,
    "Technical Specifications-product-specifciation-Tab": 1, "Packaging Details-product-specifciation-Tab": 1,
    "Certifications and Compliance-product-specifciation-Tab": 1, "Shipping option-product-specifciation-Tab": 1,
    "Warranty Information-product-specifciation-Tab": 1, "Product Description-product-specifciation-Tab": 1,
    "Return Policy-product-specifciation-Tab": 1, "product-image-click": 1, "visit-store-link": 1, "view-more-pdp": 1,
}
DEEP_SCROLL = 75.0
PRODUCTS_SHOWN, PLACES_SHOWN = 20, 50
RFQ_AS_ENQUIRY = ["submitted", "active", "open"]

COUNTS = ("total_sessions", "total_page_views", "product_page_views", "total_clicks", "high_intent_score",
          "sessions_deep_scroll", "enquiries_sent", "quote_requests", "messages_sent", "searches_done")


def element_weight(name: Column) -> Column:
    return lookup(ELEMENT_WEIGHTS, F.trim(text(name)), 0)


def button_weight(button: Column) -> Column:
    return lookup(BUTTON_WEIGHTS, F.trim(text(button)), 0)


def click_weights(clicks: DataFrame, name: str, by_button: bool) -> DataFrame:
    """Adds the purchase-intent weight 0..3 of each click."""
    return clicks.withColumn("weight", (button_weight if by_button else element_weight)(F.col(name)).cast("long"))


def profile_keywords(searches: DataFrame) -> DataFrame:
    """Every keyword of every user: user_id, keyword, searches (all), most_at_once (the largest single count)."""
    return searches.where("deleted_at is null and user_id > 0 and name is not null").groupBy(
        F.col("user_id").cast("string").alias("user_id"), F.col("name").alias("keyword")).agg(
        F.sum("searched_total").alias("searches"), F.max("searched_total").alias("most_at_once"))


def _owned(sessions: DataFrame, *extra: str) -> DataFrame:
    return sessions.where(F.col("user_id") > 0).select("session_id", F.col("user_id").cast("string").alias("user_id"), *extra)


def profile_products(page_views: DataFrame, sessions: DataFrame) -> DataFrame:
    """Every product page of every user: user_id, product_id, views."""
    seen = page_views.where((F.col("type") == PRODUCT_PAGE) & F.col("deleted_at").isNull() & non_empty("product_id").isNotNull())
    per = seen.groupBy("session_id", F.col("product_id").cast("string").alias("product_id")).agg(F.count(F.lit(1)).alias("n"))
    return per.join(_owned(sessions), "session_id").groupBy("user_id", "product_id").agg(F.sum("n").alias("views"))


def _first_values(rows: DataFrame, value: str, order: Sequence[Column], most: int, name: str, by_value: bool = False) -> DataFrame:
    """The first ``most`` values of every user as an array, in that order or sorted by value."""
    kept = top_k(rows, ["user_id"], order, most).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", value))).alias("v"))
    values = F.transform("v", lambda v: v[value])
    return kept.select("user_id", (F.array_sort(values) if by_value else values).alias(name))


def buyer_profiles(sessions: DataFrame, clicks: DataFrame, scrolls: DataFrame, page_views: DataFrame,
                   searches: DataFrame, messages: DataFrame, enquiries: DataFrame, rfqs: DataFrame,
                   button_events: DataFrame, *, keywords: int, products: int = PRODUCTS_SHOWN, places: int = PLACES_SHOWN) -> DataFrame:
    """One row per user seen in any source.

    Arrays in a profile are bounded: search_keywords (as many as ``keywords`` says, most searched first), products_top,
    buyer_countries and buyer_devices. ``profile_keywords`` and ``profile_products`` give all of them as rows. Each source is aggregated to its user first, the small results are put in one long frame and
    added up, so there is one final shuffle and no outer-join chain. ``button_events`` holds the
    two button tables together.
    """
    owned = _owned(sessions)
    zero = F.lit(0).cast("long")
    parts = []

    def add(rows: DataFrame, last: str | None = None, **counts: str) -> None:
        parts.append(rows.select(
            "user_id", *[(F.coalesce(F.col(counts[c]).cast("long"), zero) if c in counts else zero).alias(c) for c in COUNTS],
            (F.col("_depth") if "_depth" in rows.columns else F.lit(None).cast("double")).alias("max_scroll_depth"),
            (F.col(last) if last else F.lit(None)).cast("timestamp").alias("last_activity_at"),
            (F.col("_enq") if "_enq" in rows.columns else F.lit(False)).alias("has_enquiry")))

    add(sessions.where(F.col("user_id") > 0).groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("created_at").alias("last")), "last", total_sessions="n")

    named = click_weights(clicks.join(owned, "session_id"), "element_type", False).select(
        "user_id", F.trim(text("element_type")).alias("button"), "weight", F.lit(None).cast("timestamp").alias("at"))
    pressed = click_weights(button_events.where("user_id <> '' and button_identity <> ''"), "button_identity", True).select(
        F.col("user_id").cast("string").alias("user_id"), F.trim("button_identity").alias("button"), "weight",
        F.col("created_at").cast("timestamp").alias("at"))
    tally = named.unionByName(pressed).groupBy("user_id", "button").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"), F.max("at").alias("last"))
    add(tally.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max("last").alias("last")),
        "last", total_clicks="n", high_intent_score="w")

    deepest = scrolls.groupBy("session_id").agg(F.max(F.col("average").cast("double")).alias("d"))
    add(deepest.join(owned, "session_id").groupBy("user_id").agg(
        F.max("d").alias("_depth"), F.count_if(F.col("d") >= DEEP_SCROLL).alias("n")), sessions_deep_scroll="n")

    add(page_views.where("deleted_at is null").groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("type") == PRODUCT_PAGE).alias("p"),
        F.max("created_at").alias("last")).join(owned, "session_id").groupBy("user_id").agg(
        F.sum("n").alias("n"), F.sum("p").alias("p"), F.max("last").alias("last")),
        "last", total_page_views="n", product_page_views="p")

    add(enquiries.where("deleted_at is null and enquiry_user_id > 0").groupBy(
        F.col("enquiry_user_id").cast("string").alias("user_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("enquiry_type") == "quote").alias("q"),
        F.max("created_at").alias("last"), F.lit(True).alias("_enq")), "last", enquiries_sent="n", quote_requests="q")

    add(searches.where("deleted_at is null and user_id > 0").groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.sum("searched_total").alias("n")), searches_done="n")

    add(messages.where(F.col("user_id") > 0).groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.count(F.lit(1)).alias("n")), messages_sent="n")

    add(rfqs.where("user_id is not null").groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.count_if(F.col("status").isin(*RFQ_AS_ENQUIRY)).alias("n"), F.count_if(F.col("status") == "submitted").alias("q"),
        F.max("created_at").alias("last"), F.lit(True).alias("_enq")), "last", enquiries_sent="n", quote_requests="q")

    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    profile = long.groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.coalesce(F.max("max_scroll_depth"), F.lit(0.0)).alias("max_scroll_depth"),
        F.max("last_activity_at").alias("last_activity_at"), F.max("has_enquiry").alias("has_enquiry"))

    # Only named, weighted buttons are tallied: at most as many per user as the two maps have.
    detail = tally.where("w > 0").groupBy("user_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "button"))),
        lambda b: F.concat(b["button"], F.lit(":"), (-b["k"]).cast("string"))), "|").alias("high_intent_detail"))
    viewed = profile_products(page_views, sessions)
    viewed_count = viewed.groupBy("user_id").agg(F.count(F.lit(1)).alias("products_viewed_count"))
    facets = [detail, viewed_count,
              _first_values(profile_keywords(searches), "keyword", [-F.col("most_at_once"), F.col("keyword")], keywords, "search_keywords"),
              _first_values(viewed, "product_id", [-F.col("views"), F.col("product_id")], products, "products_top")]
    for column, name in (("country", "buyer_countries"), ("device", "buyer_devices")):
        used = _owned(sessions, column).where(non_empty(column).isNotNull()).groupBy("user_id", column).agg(F.count(F.lit(1)).alias("n"))
        facets.append(_first_values(used, column, [-F.col("n"), F.col(column)], places, name, by_value=True))
    for facet in facets:
        profile = profile.join(facet, "user_id", "left")
    nothing = F.array().cast("array<string>")
    return profile.withColumns({
        "high_intent_detail": text("high_intent_detail"), "products_viewed_count": F.coalesce("products_viewed_count", zero),
        **{c: F.coalesce(c, nothing) for c in ("search_keywords", "products_top", "buyer_countries", "buyer_devices")},
        "profile_uid": F.concat(F.lit("buyer_profile:"), F.col("user_id"))})


def behavior_score(profiles: DataFrame) -> DataFrame:
    """Adds behavioral_score 30..100; every kind of activity has its own ceiling."""
    def upto(col: str, points: int, most: int) -> Column:
        return F.least(F.col(col) * points, F.lit(most))
    total = (30 + upto("enquiries_sent", 8, 40) + upto("high_intent_score", 2, 20) + upto("total_sessions", 2, 10)
             + upto("sessions_deep_scroll", 2, 8) + upto("searches_done", 1, 5) + upto("messages_sent", 3, 9))
    return profiles.withColumn("behavioral_score", F.least(total, F.lit(100)).cast("long"))


def profile_lead_type(scored: DataFrame) -> DataFrame:
    """Adds lead_type_signal and lead_score from a scored profile."""
    s, intent = F.col("behavioral_score"), F.col("high_intent_score")
    quote = (F.col("enquiries_sent") > 0) & (F.col("quote_requests") > 0)
    enquired = F.col("enquiries_sent") > 0
    engaged = (intent >= 6) | (F.col("messages_sent") > 0)
    active = (F.col("product_page_views") >= 3) | (F.col("total_sessions") >= 2)
    return scored.withColumns({
        "lead_type_signal": choose([(quote, "quote_ready"), (enquired, "rfq_submitted"), (engaged, "engaged_person"),
                                    (intent >= 2, "known_account_interest")], "visit_only"),
        "lead_score": choose([(quote, F.least(s + 5, F.lit(100))), (enquired, s), (engaged, F.least(s, F.lit(80))),
                              (intent >= 2, F.least(s, F.lit(70))), (active, F.greatest(s, F.lit(40)))], 40).cast("long")})


def click_intent_leads(typed: DataFrame, known: DataFrame, prefix: str = SourcePrefixes().app) -> DataFrame:
    """Leads for users who pressed telling buttons but never enquired."""
    rows = typed.where(~F.col("has_enquiry") & (F.col("high_intent_score") >= 2) & (F.col("lead_type_signal") != "visit_only"))
    made = rows.select(
        F.concat(F.lit("behavioral:"), F.col("lead_type_signal"), F.lit(":click_behavior:"), F.col("user_id")).alias("lead_uid"),
        F.col("lead_type_signal").alias("lead_type"), F.col("lead_score").alias("score_final"),
        F.lit("seller_visible").alias("visibility_level"), F.lit(f"{prefix}_behavior").alias("source"),
        F.concat(F.lit("click_behavior:"), F.col("user_id")).alias("source_ref"), F.col("user_id").alias("buyer_user_id"),
        "high_intent_score", F.col("high_intent_detail").alias("click_detail"), "behavioral_score")
    return made.join(known.select("lead_uid"), "lead_uid", "left_anti")


def enrich_leads_with_behavior(leads: DataFrame, scored: DataFrame) -> DataFrame:
    """Profile scores on the user's leads unless set by hand; ``profile_uid`` is the edge to the profile."""
    facts = scored.select(F.col("user_id").alias("buyer_user_id"), "profile_uid", F.col("behavioral_score").alias("_b"),
                          F.col("high_intent_score").alias("_h"), F.col("total_sessions").alias("_s"))
    joined = leads.join(facts, "buyer_user_id", "left")
    free = F.col("_b").isNotNull() & ~F.coalesce("score_override", F.lit(False))
    return joined.withColumns({
        "behavioral_score": F.when(free, F.col("_b")), "high_intent_score": F.when(free, F.col("_h")),
        "total_sessions": F.when(free, F.col("_s")), "profile_uid": F.when(free, F.col("profile_uid"))}).drop("_b", "_h", "_s")


def behavior_summary(scored: DataFrame) -> DataFrame:
    """One row of totals over all profiles."""
    return scored.agg(
        F.count(F.lit(1)).alias("total_profiles"), F.round(F.avg("behavioral_score"), 1).alias("avg_score"),
        F.count_if(F.col("behavioral_score") >= 70).alias("high_intent"),
        F.count_if(F.col("enquiries_sent") > 0).alias("enquiry_buyers"),
        F.count_if(F.col("high_intent_score") >= 6).alias("strong_clickers"),
        F.count_if(F.col("sessions_deep_scroll") >= 1).alias("deep_readers"),
        F.count_if(F.col("messages_sent") > 0).alias("chatted"))


def top_engaged(scored: DataFrame, k: int) -> DataFrame:
    """The k highest scores among profiles with telling clicks."""
    return scored.where("high_intent_detail <> ''").orderBy(F.desc("behavioral_score"), "user_id").limit(k).select(
        "user_id", "behavioral_score", "high_intent_detail")


UTM = "struct<utm_source: string, utm_medium: string, utm_campaign: string>"


def visit_facts(visits: DataFrame) -> DataFrame:
    """Per paid campaign (UTM JSON of the visit): visits, users, mean depth and stay, clicks."""
    rows = visits.withColumn("utm", F.from_json("utm_data", UTM))
    per_user = rows.groupBy(
        F.coalesce("utm.utm_source", F.lit("")).alias("utm_source"),
        F.coalesce("utm.utm_campaign", F.lit("")).alias("utm_campaign"), "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("max_scroll_depth").alias("d"), F.sum("stay_on_page").alias("s"),
        F.sum("element_clicks").alias("c"))
    return per_user.groupBy("utm_source", "utm_campaign").agg(
        F.sum("n").alias("visits"), F.count("user_id").alias("users"),
        (F.sum("d") / F.sum("n")).alias("mean_scroll_depth"), (F.sum("s") / F.sum("n")).alias("mean_stay"),
        F.sum("c").alias("clicks"))
