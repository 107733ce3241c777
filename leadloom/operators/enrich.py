"""Company profiles, contacts, intent and news onto organisations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.functions.rank import best_row
from leadloom.functions.skew import grid_join
from leadloom.functions.values import choose, first_non_empty, norm, text
from leadloom.session import staged

# Words that mark decision makers and company events.
DECISION_MAKER_WORDS = ["procurement", "supply chain", "purchasing", "cpo", "vp supply", "sourcing",
                        "operations", "logistics"]
LEADERSHIP_WORDS = ["ceo", "cpo", "vp", "director", "chief", "president", "appoint", "resign", "hire", "named"]
FUNDING_WORDS = ["funding", "investment", "raise", "series", "capital", "venture", "ipo"]
MERGER_WORDS = ["merger", "acquisition", "acquire", "merge", "takeover", "buyout"]
WIDTHS = (1, 2, 3, 4, 6, 8, 12)  # of grams; a pattern uses the largest not longer than itself


def any_word(haystack: Column, words: Sequence[str]) -> Column:
    """True when the lower-cased text holds any of the words as a substring."""
    low, out = F.lower(haystack), F.lit(False)
    for word in words:
        out = out | F.contains(low, F.lit(word))
    return F.coalesce(out, F.lit(False))


def _grams(col: Column, width: Column) -> Column:
    """Distinct substrings of one width."""
    last = F.length(col) - width + 1
    return F.array_distinct(F.transform(
        F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.substring(col, i, width)))


def contains_pairs(long_side: DataFrame, long_col: str, short_side: DataFrame, short_col: str) -> DataFrame:
    """All distinct value pairs (``long_text``, ``short_text``) where the long one holds the short one.

    Exact substring join without a nested loop. A text that holds a pattern holds all its grams, so each pattern is looked up
    through one gram: of the largest width in ``WIDTHS`` that it is long enough for, the rarest among the long texts. Long
    texts are cut into grams of the widths that patterns use and keep those that patterns have. The candidates are verified.
    Both sides are distinct lower-cased values, so repeated names cost nothing, and a gram of many texts and patterns is cut
    up (``grid_join``).
    """
    longs = staged(long_side.select(F.lower(long_col).alias("long_text")).where("long_text <> ''").distinct(), "long_texts")
    width = choose([(F.length("short_text") >= w, w) for w in sorted(WIDTHS, reverse=True)], 1)
    shorts = staged(short_side.select(F.lower(short_col).alias("short_text")).where("short_text <> ''").distinct().withColumn(
        "width", width.cast("int")), "patterns")
    used = sorted(r[0] for r in shorts.select("width").distinct().collect())  # at most as many as WIDTHS
    if not used:
        return longs.select("long_text", F.col("long_text").alias("short_text")).limit(0)
    short_grams = staged(shorts.select("short_text", F.explode(_grams(F.col("short_text"), F.col("width"))).alias("gram")), "pattern_grams")
    long_grams = longs.select("long_text", F.explode(F.concat(*[_grams(F.col("long_text"), F.lit(n)) for n in used])).alias("gram"))
    long_grams = staged(long_grams.join(short_grams.select("gram").distinct(), "gram", "left_semi"), "text_grams")
    freq = long_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # A pattern with a gram no text has cannot match: the left join leaves n null, sorted first.
    rare = short_grams.join(freq, "gram", "left").groupBy("short_text").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("m"))
    rare = staged(rare.where("m.n > 0").select("short_text", F.col("m.gram").alias("gram")), "rare_grams")
    return grid_join(rare, long_grams, ["gram"], condition=F.contains("long_text", "short_text")).select("long_text", "short_text")


def match_profiles(profiles: DataFrame, orgs: DataFrame) -> DataFrame:
    """Latest profile per company onto organisations: by id, else earlier tag, else equal name.

    Three equi joins; the name is tried only for profiles neither id nor tag found.
    """
    clean = profiles.where(F.trim("company_id") != "").withColumn("company_id", F.trim("company_id"))
    latest = best_row(clean, ["company_id"], [F.col("modified_on")])
    by_id = latest.join(orgs.select(F.col("org_id")), latest.company_id == F.col("org_id")).select(
        "company_id", "org_id", F.lit("id").alias("matched_by"))
    tagged = orgs.where(F.col("profile_tag").isNotNull()).select("org_id", "profile_tag")
    by_tag = latest.join(by_id, "company_id", "left_anti").join(
        tagged, F.col("company_id") == F.col("profile_tag")).select(
        "company_id", "org_id", F.lit("tag").alias("matched_by"))
    done = by_id.unionByName(by_tag)
    named = orgs.select("org_id", F.lower("org_name").alias("_name"))
    rest = latest.join(done, "company_id", "left_anti").where(F.trim("company_name") != "")
    by_name = rest.join(named, F.lower(F.trim("company_name")) == F.col("_name")).select(
        "company_id", "org_id", F.lit("name").alias("matched_by"))
    return done.unionByName(by_name).join(latest, "company_id").select(
        "org_id", "company_id", "matched_by", "trade_health_score", "supplier_risk_score",
        "total_shipment_count", "company_type")


def enrich_orgs_by_name(orgs: DataFrame, companies: DataFrame) -> DataFrame:
    """Firmographics onto an organisation whose name holds the company name, or whose domain is equal.

    Several companies may fit one organisation: the longest name wins, then the company name.
    """
    usable = companies.where(F.trim("company_name") != "").withColumn("company_name", F.trim("company_name"))
    pairs = contains_pairs(orgs, "org_name", usable, "company_name")
    cols = ["company_name", "employee_count", "industry", "domain", "country"]
    order = [F.length("company_name"), F.col("company_name")]
    # the best company of a name or a domain is the best for all organisations that hold it
    named = best_row(usable.select(F.lower("company_name").alias("short_text"), *cols), ["short_text"], order)
    per_name = best_row(pairs.join(named, "short_text").drop("short_text"), ["long_text"], order)
    per_domain = best_row(usable.where("domain <> ''").select(F.col("domain").alias("_domain"), *cols), ["_domain"], order)
    by_name = orgs.select("org_id", F.lower("org_name").alias("long_text")).join(per_name, "long_text")
    by_domain = orgs.select("org_id", F.col("domain").alias("_domain")).join(per_domain, "_domain")
    hits = by_name.select("org_id", *cols).unionByName(by_domain.select("org_id", *cols))
    best = best_row(hits, ["org_id"], order)
    return best.select("org_id", F.col("company_name").alias("matched_company"), "employee_count", "industry",
                       F.col("domain").alias("company_domain"), F.col("country").alias("company_country"))


def contacts(rows: DataFrame) -> DataFrame:
    """Clean contacts, one per person key (e-mail, else ``zi:`` and the name)."""
    joined = F.trim(F.concat_ws(" ", F.trim(text("first_name")), F.trim(text("last_name"))))
    clean = rows.select(
        F.coalesce(F.nullif(F.trim(text("full_name")), F.lit("")), F.nullif(joined, F.lit("")),
                   F.lit("Unknown")).alias("name"),
        text("title").alias("title"), text("email").alias("email"), text("phone").alias("phone"),
        text("company_name").alias("company_name"), text("seniority_level").alias("seniority_level"))
    keyed = clean.withColumn("person_key", first_non_empty(
        "email", F.concat(F.lit("zi:"), F.col("name")))).withColumn(
        "is_decision_maker", any_word(F.col("title"), DECISION_MAKER_WORDS))
    return best_row(keyed, ["person_key"], [F.col("is_decision_maker"), F.col("title")])


def contact_links(people: DataFrame, orgs: DataFrame) -> DataFrame:
    """person_key -> org_id where the organisation's name holds the contact's company name."""
    named = people.where("company_name <> ''")
    pairs = contains_pairs(orgs, "org_name", named, "company_name")
    held = staged(pairs.join(orgs.select("org_id", F.lower("org_name").alias("long_text")).distinct(), "long_text").select("short_text", "org_id").distinct(), "held")
    who = named.select("person_key", F.lower("company_name").alias("short_text")).distinct()
    several = F.count(F.lit(1)).over(Window.partitionBy(F.col("person_key"))) > 1
    who = staged(who.withColumn("several", several), "people")
    # only a contact of several companies can reach an organisation twice
    once = grid_join(who.where("NOT several").drop("several"), held, ["short_text"]).select("person_key", "org_id")
    return once.unionByName(grid_join(who.where("several").drop("several"), held, ["short_text"]).select("person_key", "org_id").distinct())


def intent_per_company(rows: DataFrame) -> DataFrame:
    """Per company: signal count, sorted distinct topics as text, last date (ISO text)."""
    clean = rows.select(F.trim("company_name").alias("company_name"), F.trim(text("topic")).alias("topic"),
                        text("signal_date").alias("signal_date")).where("company_name <> ''")
    # Two levels: equal topics collapse map-side before they are collected per company.
    per_topic = clean.groupBy("company_name", "topic").agg(
        F.count(F.lit(1)).alias("n"), F.max("signal_date").alias("last"))
    return per_topic.groupBy("company_name").agg(
        F.sum("n").alias("intent_signal_count"),
        F.array_join(F.array_sort(F.collect_list(F.nullif("topic", F.lit("")))), ", ").alias("intent_topics"),
        F.max("last").alias("last_intent_date"))


def news_flags(*feeds: DataFrame) -> DataFrame:
    """Per company over all news feeds: count, last date, and three any-keyword event flags."""
    rows = None
    for feed in feeds:
        part = feed.select(F.trim("company_name").alias("company_name"), text("content").alias("content"),
                           text("news_date").alias("news_date"))
        rows = part if rows is None else rows.unionAll(part)
    return rows.where("company_name <> ''").groupBy("company_name").agg(
        F.count(F.lit(1)).alias("news_count"), F.max("news_date").alias("last_news_date"),
        F.max(any_word(F.col("content"), LEADERSHIP_WORDS)).alias("has_leadership_change"),
        F.max(any_word(F.col("content"), FUNDING_WORDS)).alias("has_funding_event"),
        F.max(any_word(F.col("content"), MERGER_WORDS)).alias("has_ma_event"))


def matched_by_name(orgs: DataFrame, facts: DataFrame) -> DataFrame:
    """Per-company facts (intent, news) onto every organisation whose name holds the company name."""
    pairs = contains_pairs(orgs, "org_name", facts, "company_name")
    return orgs.select("org_id", F.lower("org_name").alias("long_text")).join(pairs, "long_text").join(
        facts.withColumn("short_text", F.lower("company_name")), "short_text").drop("long_text", "short_text")
