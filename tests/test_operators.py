"""Edge rows, and the operators SQL cannot state, against plain Python."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from leadloom.operators import (
    behavior, enrich, factory, feedback, governance, health, layers, merge, models, platform_leads, sellers, signals, switch, trade)
from tests.conftest import rows

AS_OF = "2024-01-31 00:00:00"


def ship(spark, data):
    return spark.createDataFrame(data, "buyer_id string, buyer_name string, supplier_id string, supplier_name string, "
                                 "hs_code string, quantity double, value double, ship_date timestamp")


def test_relationship_is_one_row_whatever_the_names(spark):
    day = dt.datetime
    data = [("B", None, "S", "Sup", "6802", 1.0, 2.0, day(2023, 1, 5)), ("B", "Name", "S", "Other", "6802", None, None, day(2023, 3, 5)),
            (" ", "x", "S", "Sup", "6802", 1.0, 1.0, day(2023, 1, 5)), ("B", "x", "S", "Sup", None, 1.0, 1.0, day(2023, 1, 5)),
            ("B", "old", "S", "Sup", "6802", 9.0, 9.0, day(2019, 1, 5))]
    monthly = trade.monthly_trade(ship(spark, data), AS_OF)
    rel = trade.trade_relationships(monthly).collect()
    assert len(rel) == 1
    assert (rel[0].buyer_name, rel[0].supplier_name, rel[0].total_shipments, rel[0].relationship_age_months) == ("Name", "Sup", 2, 2)
    assert rel[0].baseline_avg_qty == 0.5 and rel[0].last_shipment_date == dt.date(2023, 3, 5)


@pytest.mark.parametrize("days,status", [(44, "healthy"), (45, "stressed"), (90, "stressed"), (91, "dormant"),
                                         (180, "dormant"), (181, "churned")])
def test_stress_rules_at_the_limits(spark, days, status):
    day = dt.datetime(2024, 1, 31) - dt.timedelta(days=days)
    monthly = trade.monthly_trade(ship(spark, [("B", "b", "S", "s", "6802", 5.0, 1.0, day)]), AS_OF)
    got = health.stress_rules(trade.trade_relationships(monthly), trade.trade_snapshots(monthly), AS_OF).first()
    assert (got.rule_status, got.rule_days_silent) == (status, days)


def test_missing_last_date_is_dormant_without_history(spark):
    rels = spark.createDataFrame([("r", "B", "b", "S", "s", "1", 0.0, None)], "rel_id string, buyer_id string, buyer_name string, "
                                 "supplier_id string, supplier_name string, hs_code string, baseline_avg_qty double, last_shipment_date date")
    snaps = spark.createDataFrame([], "rel_id string, year_month date, shipment_count long, total_quantity double")
    got = health.stress_rules(rels, snaps, AS_OF).first()
    assert (got.rule_status, got.rule_days_silent) == ("dormant", None)


def test_contains_pairs_against_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 12))).strip() or "a" for _ in range(120)]
    longs = spark.createDataFrame([(w,) for w in words], "t string")
    shorts = spark.createDataFrame([(w[:rng.randint(1, 5)] or "a",) for w in words], "t string")
    got = {tuple(r) for r in enrich.contains_pairs(longs, "t", shorts, "t").collect()}
    want = {(a, b) for a in set(words) for b in {r.t for r in shorts.collect()} if b and b in a}
    assert got == want


def test_evidence_windows_and_ages(spark):
    now = dt.datetime(2024, 1, 31)
    data = [(f"s{n}", "rfq_created", "RFQInquirySource", now - dt.timedelta(days=d)) for n, d in enumerate([0, 7, 8, -3])]
    sig = spark.createDataFrame(data, "signal_uid string, signal_type string, source_family string, occurred_at timestamp")
    for name in ("account_hint", "person_hint", "domain_hint", "email_hint", "phone_hint", "product_hint", "category_hint", "hs_code",
                 "session_id", "confidence_score", "number_of_shipments"):
        sig = sig.withColumn(name, F.lit(None).cast("string"))
    got = {r.signal_uid: (r.signal_age_days, r.evidence_strength) for r in factory.evidence(factory.with_evidence(factory.with_identity(sig), AS_OF)).collect()}
    assert got == {"s0": (0, 80), "s1": (7, 63), "s3": (0, 80)}


def test_dedup_leaves_one_visible_lead_per_buyer(spark):
    data = [(f"l{n}", "k" if n % 3 else "z", float(n % 5), n % 4 > 0, "feed") for n in range(40)]
    leads = spark.createDataFrame(data, "lead_uid string, buyer_account_key string, final_score double, seller_visible boolean, visibility string")
    out = factory.dedup_leads(leads.withColumn("routing_eligible", F.col("seller_visible")))
    shown = out.where("seller_visible").groupBy("buyer_account_key").count().collect()
    assert {r["count"] for r in shown} == {1} and out.count() == 40


def test_merge_keeps_created_and_rejects_duplicates(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "k int, v string, created_by string")
    new = spark.createDataFrame([(2, "B", "y"), (3, "c", "y")], "k int, v string, created_by string")
    assert rows(merge.keyed_merge(old, new, ["k"])) == [(1, "a", "x"), (2, "B", "x"), (3, "c", "y")]
    with pytest.raises(Exception, match="duplicate key"):
        merge.keyed_merge(old, new.union(new), ["k"]).collect()


def test_surrogate_keys_have_no_gaps(spark):
    data = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = [r.k for r in merge.surrogate_key(data, "k", ["v"], partitions=7).orderBy("v").collect()]
    assert got == list(range(1, 1001))
    more = merge.surrogate_key(data, "k", ["v"], existing=spark.createDataFrame([(41,)], "k long"))
    assert (more.agg(F.min("k")).first()[0], more.agg(F.max("k")).first()[0]) == (42, 1041)


def test_feed_rerun_changes_nothing(spark):
    bronze = spark.createDataFrame([("1", "US", "z", "h", "buyer", 5), ("1", "US", "z", "h", "buyer", 9), ("2", None, None, "h", "buyer", 1)],
                                   "company_id string, country string, zip_code string, matched_hs_codes string, company_role string, number_of_shipments int")
    feed = layers.FEEDS["buyer_supplier_list"]
    first = layers.silver(bronze, None, feed, AS_OF, "t")
    empty = first.where("false").select(F.lit(0).cast("long").alias(feed.gold_key), "*")
    gold = layers.gold(first, empty, feed)
    again = layers.gold(layers.silver(bronze, first, feed, AS_OF, "t"), gold, feed)
    assert rows(gold.select("bsl_key", "hash_key", "number_of_shipments")) == rows(again.select("bsl_key", "hash_key", "number_of_shipments"))
    assert gold.count() == 2


def test_tree_with_cycle_and_depth(spark):
    edges = spark.createDataFrame([(1, 0, "r"), (2, 1, "a"), (3, 2, "b"), (4, 3, "c"), (8, 9, "x"), (9, 8, "y")], "node long, parent long, name string")
    got = {(r.node, r.level) for r in layers.family_tree_edges(edges).collect()}
    assert got == {(1, 0), (2, 1), (3, 2), (4, 3)}


def market(spark, seed, n_leads=60, n_sellers=8):
    rng = random.Random(seed)
    leads = [(f"L{i:03d}", rng.choice(["critical", "high", "medium", "low", "none"]), rng.randint(0, 9), rng.choice(["6802", "[6901]", "7003"]),
              rng.choice(["us", "nl"]), rng.choice(["feed", "priority"])) for i in range(n_leads)]
    people = [(f"S{i}", rng.choice([None, ["68"], ["69", "70"]]), rng.choice([None, ["US"], ["*"], ["NL", "US"]]), rng.randint(0, 7), rng.randint(0, 2),
               float(rng.randint(0, 20)), rng.random() > 0.1) for i in range(n_sellers)]
    return leads, people, spark.createDataFrame(leads, "lead_id string, priority string, score int, hs_code string, buyer_country string, visibility string"), \
        spark.createDataFrame(people, "seller_id string, hs_chapters array<string>, target_countries array<string>, max_leads_per_day int, leads_today int, credits_available double, active boolean")


def one_by_one(leads, people, order_of, per_lead):
    """The plain loop: leads by priority, score, id; each takes its first sellers with room."""
    cost = {"critical": 5, "high": 3, "medium": 1}
    place = {"critical": 1, "high": 2, "medium": 3}
    cap, credit = {p[0]: p[3] - p[4] for p in people}, {p[0]: p[5] for p in people}
    out = set()
    for lead in sorted(leads, key=lambda x: (place.get(x[1], 4), -x[2], x[0])):
        chapter, country, price, got = lead[3].strip("[]")[:2], lead[4].upper(), cost.get(lead[1], 0), 0
        for p in order_of(lead):
            fits = p[6] and (p[1] is None or chapter in p[1]) and (p[2] is None or country in p[2] or "*" in p[2])
            if fits and cap[p[0]] > 0 and credit[p[0]] >= price and (per_lead is None or got < per_lead):
                cap[p[0]] -= 1
                credit[p[0]] -= price
                got += 1
                out.add((p[0], lead[0]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_assignment_equals_the_plain_loop(spark, seed):
    leads, people, lead_df, seller_df = market(spark, seed)
    by_id = sorted(people)
    shared = {(r.seller_id, r.lead_id) for r in sellers.assign_leads(lead_df, seller_df).collect()}
    assert shared == one_by_one(leads, people, lambda _: by_id, None)
    three = {(r.seller_id, r.lead_id) for r in sellers.assign_switch_leads(lead_df, seller_df).collect()}
    assert three == one_by_one(leads, people, lambda _: by_id, 3)


@pytest.mark.parametrize("seed", [6])
def test_exclusive_assignment_equals_the_plain_loop(spark, seed):
    leads, people, lead_df, seller_df = market(spark, seed, n_leads=120)
    stats = spark.createDataFrame([(p[0], n * 7, 0.1 * n, 10.0 * n) for n, p in enumerate(people)],
                                  "seller_id string, total_assigned int, win_rate double, avg_response_h double")
    ranks = {(r.hs_chapter, r.country, r.visibility, r.seller_id): r["rank"]
             for r in sellers.rank_sellers(lead_df, seller_df.where("active"), stats, k=None).collect()}

    def order(lead):
        key = (lead[3].strip("[]")[:2], lead[4].upper(), lead[5])
        return sorted((p for p in people if (*key, p[0]) in ranks), key=lambda p: ranks[(*key, p[0])])
    got = {(r.seller_id, r.lead_id) for r in sellers.assign_exclusive(lead_df, seller_df, stats).collect()}
    assert got == one_by_one(leads, people, order, 1) and got
    assert sellers.assign_exclusive(lead_df, seller_df.withColumn("credits_available", F.lit(-1.0)), stats).count() == 0
    assert sellers.assign_exclusive(lead_df.where("1 = 0"), seller_df, stats).count() == 0


def queue(spark, n_leads, n_sellers, room):
    """Every seller serves every lead and is soon full, so each lead may be passed on along the whole list."""
    leads = [(f"L{i:03d}", ("high", "low")[i % 2], i % 7, "6802", "us", "feed") for i in range(n_leads)]
    people = [(f"S{i:02d}", None, None, room, 0, 4.0, True) for i in range(n_sellers)]
    return leads, people, spark.createDataFrame(leads, "lead_id string, priority string, score int, hs_code string, buyer_country string, visibility string"), \
        spark.createDataFrame(people, "seller_id string, hs_chapters array<string>, target_countries array<string>, max_leads_per_day int, leads_today int, credits_available double, active boolean")


@pytest.fixture
def served_slices(monkeypatch):
    """Rounds of an assignment, in slices of 20 leads."""
    rounds, serve = [], sellers._serve
    monkeypatch.setattr(sellers, "SLICE", 20)
    monkeypatch.setattr(sellers, "_serve", lambda per_lead: rounds.append(per_lead) or serve(per_lead))
    return rounds


def test_exclusive_assignment_takes_no_more_rounds_than_slices(spark, served_slices):
    leads, people, lead_df, seller_df = queue(spark, 60, 30, 2)
    stats = spark.createDataFrame([], "seller_id string, total_assigned int, win_rate double, avg_response_h double")
    got = {(r.seller_id, r.lead_id) for r in sellers.assign_exclusive(lead_df, seller_df, stats).collect()}
    assert got == one_by_one(leads, people, lambda _: people, 1) and len(got) == 60
    assert len(served_slices) <= 4


def test_assignment_sends_no_table_of_sellers_to_the_driver(spark, served_slices, monkeypatch):
    _, _, lead_df, seller_df = queue(spark, 60, 30, 2)
    stats = spark.createDataFrame([], "seller_id string, total_assigned int, win_rate double, avg_response_h double")
    plans, staged = {}, sellers.staged

    def kept(rows, name):
        plans.setdefault(name, rows._jdf.queryExecution().sparkPlan().toString())
        return staged(rows, name)
    monkeypatch.setattr(sellers, "staged", kept)
    out = sellers.assign_exclusive(lead_df, seller_df, stats)._jdf.queryExecution().sparkPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plans["served"]
    for plan in (plans["served"], out):
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan


def test_switch_assignment_takes_no_more_rounds_than_slices(spark, served_slices):
    leads, people, lead_df, seller_df = queue(spark, 60, 30, 3)
    got = {(r.seller_id, r.lead_id) for r in sellers.assign_switch_leads(lead_df, seller_df).collect()}
    assert got == one_by_one(leads, people, lambda _: people, 3) and len(got) == 90
    assert len(served_slices) <= 4


def test_small_switch_assignment_takes_a_round_per_class_and_few_files(spark, served_slices, monkeypatch):
    monkeypatch.setattr(sellers, "SLICE", 1000)
    leads, people, lead_df, seller_df = queue(spark, 60, 30, 3)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        got = sellers.assign_switch_leads(lead_df, seller_df)
        assert {(r.seller_id, r.lead_id) for r in got.collect()} == one_by_one(leads, people, lambda _: people, 3)
        keyed = merge.surrogate_key(spark.range(500).select(F.col("id").alias("v")), "k", ["v"])
        assert [tuple(r) for r in keyed.orderBy("v").select("k", "v").collect()] == [(v + 1, v) for v in range(500)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert len(served_slices) == 2 and len(keyed.inputFiles()) < 50


def test_distributed_leads_are_not_handed_out_again(spark):
    leads, people, lead_df, seller_df = market(spark, 3)
    lead_df = lead_df.withColumns({"seller_visible": F.lit(True), "distribution_status": F.lit(None).cast("string"), "lead_type": F.lit("t")})
    first = sellers.assign_leads(sellers.pending_leads(lead_df), seller_df)
    marked = sellers.mark_distributed(lead_df, first, AS_OF)
    left = sellers.pending_leads(marked)
    taken = {r.lead_id for r in first.collect()}
    assert taken and not taken & {r.lead_id for r in left.collect()} and left.count() == len(leads) - len(taken)
    again = sellers.assign_leads(left, seller_df.withColumn("max_leads_per_day", F.col("leads_today")))  # nobody has room any more
    assert again.count() == 0 and rows(sellers.mark_distributed(marked, again, "2030-01-01").select("lead_id", "distributed_at")) == rows(marked.select("lead_id", "distributed_at"))


def test_credit_ledger_equals_the_plain_loop(spark):
    rng = random.Random(9)
    accounts = [(f"S{i}", float(rng.randint(0, 12)), 0.0, -1.0 if i == 0 else 100.0) for i in range(6)]
    moves = [(f"t{n:03d}", f"S{rng.randint(0, 5)}", rng.choice(["deduct", "deduct", "topup"]), float(rng.choice([1, 3, 5])),
              dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * n)) for n in range(150)]
    got = {r.seller_id: (r.credits_available, r.credits_used, r.refused) for r in sellers.credit_ledger(
        spark.createDataFrame(accounts, "seller_id string, credits_available double, credits_used_month double, credits_total_month double"),
        spark.createDataFrame(moves, "tx_id string, seller_id string, kind string, amount double, at timestamp")).collect()}
    for seller, balance, used, total in accounts:
        refused = 0
        for _, who, kind, amount, _ in moves:
            if who != seller:
                continue
            if kind == "topup":
                balance += amount
            elif total == -1 or amount <= balance:
                balance, used = balance - (0 if total == -1 else amount), used + amount
            else:
                refused += 1
        assert got[seller] == (balance, used, refused), seller


def test_demotion_cap_takes_the_longest_untouched(spark):
    data = [(f"l{n}", "intent_only", 50, "feed", dt.datetime(2023, 1, 1) + dt.timedelta(days=n)) for n in range(10)]
    leads = spark.createDataFrame(data, "lead_uid string, lead_type string, score_final int, visibility_level string, classified_at timestamp")
    leads = leads.withColumns({"suppressed": F.lit(False), "distribution_status": F.lit(None).cast("string"),
                               "last_transition_at": F.lit(None).cast("timestamp"), "transition_count": F.lit(0)})
    moved = feedback.stale_leads(leads, AS_OF, cap=4)
    assert {r.lead_uid for r in moved.collect()} == {"l0", "l1", "l2", "l3"}
    assert feedback.stale_leads(leads, AS_OF, cap=None).count() == 10


def test_forest_finds_the_planted_outlier(spark):
    rng = random.Random(1)
    data = [(f"r{i}", rng.gauss(10, 1), rng.gauss(.2, .02), rng.gauss(0, .1), 0.0, rng.gauss(1, .05)) for i in range(300)]
    data.append(("odd", 90.0, 2.0, -9.0, 0.9, 0.01))
    df = spark.createDataFrame(data, "rel_id string, mean_qty double, cv_qty double, slope double, zero_frac double, recent_vs_baseline double")
    got = models.anomaly_forest(df, trees=30).orderBy(F.desc("anomaly_score")).collect()
    assert got[0].rel_id == "odd" and got[0].anomaly_score == 1.0 and got[-1].anomaly_score == 0.0
    again = models.anomaly_forest(df, trees=30)
    assert {r.rel_id: round(r.anomaly_score, 9) for r in got} == {r.rel_id: round(r.anomaly_score, 9) for r in again.collect()}


def test_pairwise_ranker_learns_the_direction(spark):
    rng = random.Random(4)
    data = []
    for q in range(60):
        scores = [(rng.random(), rng.random()) for _ in range(4)]
        best = max(range(4), key=lambda i: scores[i][0])
        data += [(q, i, *scores[i], int(i == best)) for i in range(4)]
    df = spark.createDataFrame(data, "q int, item int, a double, b double, won int")
    weights = models.fit_pairwise_ranker(df, "q", "won", ["a", "b"])
    assert weights[0] > abs(weights[1])
    assert models.fit_pairwise_ranker(df.where("q < 2"), "q", "won", ["a", "b"]) is None


def test_matches_stay_in_range(spark):
    rng = random.Random(2)
    rel_rows = [(f"r{n}", f"S{rng.randint(0, 30)}", f"B{rng.randint(0, 6)}", rng.choice(["68021", "68022", "70011"])) for n in range(200)]
    rels = spark.createDataFrame(rel_rows, "rel_id string, supplier_id string, buyer_id string, hs_code string").dropDuplicates(
        ["supplier_id", "buyer_id", "hs_code"]).withColumn("supplier_name", F.col("supplier_id"))
    snaps = rels.select("rel_id", F.to_date(F.lit("2024-01-01")).alias("year_month"), F.lit(1.0).alias("total_quantity"))
    firms = spark.createDataFrame([], "org_id string, employee_count long")
    people = spark.createDataFrame([("p", "S3")], "person_key string, org_id string")
    cands = switch.candidate_suppliers(rels, snaps, firms, people, AS_OF)
    opps = rels.select(F.col("rel_id").alias("opportunity_id"), "buyer_id", F.col("supplier_id").alias("existing_supplier_id"), "hs_code",
                       F.lit("open").alias("status"), F.lit(0.9).alias("switch_probability"))
    places = spark.createDataFrame([(f"B{n}", "NL" if n % 2 else "US") for n in range(6)], "buyer_id string, country string")
    got = switch.match_suppliers(opps, cands, rels, places).collect()
    assert got and all(0 <= m.match_score <= 100 and (m["rank"] == 1 or m.match_score >= 60) and m["rank"] <= 5 for m in got)
    held = {r.opportunity_id: r.existing_supplier_id for r in opps.collect()}
    assert all(m.candidate_supplier_id != held[m.opportunity_id] for m in got)


@pytest.mark.parametrize("read", [lambda df: df.select("v").collect(), lambda df: df.count(), lambda df: df.collect()])
def test_duplicate_merge_keys_raise_whatever_is_read(spark, read):
    old = spark.createDataFrame([(1, "a")], "k long, v string")
    new = spark.createDataFrame([(2, "b"), (2, "c")], "k long, v string")
    with pytest.raises(Exception, match="duplicate key"):
        read(merge.keyed_merge(old, new, ["k"]))


def test_permissions_reach_down_any_depth(spark):
    chain = [(f"s{n}", f"s{n - 1}" if n else None) for n in range(7)] + [("a", "b"), ("b", "a")]
    rules = spark.createDataFrame([("s0", "p", "deny"), ("a", "q", "allow")], "scope_id string, permission string, effect string")
    got = governance.effective_permissions(spark.createDataFrame(chain, "scope_id string, parent_id string"), rules).collect()
    assert {(r.scope_id, r.effect) for r in got if r.permission == "p"} == {(f"s{n}", "deny") for n in range(7)}
    assert {r.scope_id for r in got if r.permission == "q"} == {"a", "b"}


def test_null_natural_keys_keep_their_surrogate_key(spark):
    silver = spark.createDataFrame([("a", None, 1), (None, None, 2), ("b", "x", 3)], "p string, q string, v long")
    empty = silver.where("false").selectExpr("cast(null as long) AS k", "*")
    once = merge.gold_upsert(empty, silver, "k", ["p", "q"], ["p", "q"])
    again = merge.gold_upsert(once, silver.withColumn("v", F.col("v") * 10), "k", ["p", "q"], ["p", "q"])
    key = lambda df: {(r.p, r.q): r.k for r in df.collect()}
    assert key(once) == key(again) and sorted(key(once).values()) == [1, 2, 3]
    assert sorted(r.v for r in again.collect()) == [10, 20, 30]


def test_a_listed_star_is_no_second_market(spark):
    leads = [("L1", "low", 5, "6802", "us", "feed"), ("L2", "low", 4, "7003", "us", "feed")]
    people = [("S1", ["68", "*", "68"], ["US", "*"], 2, 0, 5.0, True), ("S2", ["*"], None, 2, 0, 5.0, True)]
    lead_df = spark.createDataFrame(leads, "lead_id string, priority string, score int, hs_code string, buyer_country string, visibility string")
    seller_df = spark.createDataFrame(people, "seller_id string, hs_chapters array<string>, target_countries array<string>, "
                                      "max_leads_per_day int, leads_today int, credits_available double, active boolean")
    got = sorted((r.seller_id, r.lead_id) for r in sellers.assign_leads(lead_df, seller_df).collect())
    assert got == sorted(one_by_one(leads, people, lambda _: people, None)) == [("S1", "L1")]


def test_long_texts_of_platform_rows_stay_whole(spark):
    known = spark.createDataFrame([], "source_ref string")
    word, day = "k" * 60, dt.datetime(2024, 1, 1)
    searches = spark.createDataFrame([(1, word + "a", 3, day, None), (1, word + "b", 5, day, None), (1, word + "b", 1, day, None), (1, None, 1, day, None),
                                      (1, "", 2, day, None)], "user_id long, name string, searched_total long, created_at timestamp, deleted_at timestamp").selectExpr("*", "7 AS category_id")
    found = platform_leads.search_leads(searches, known).collect()
    assert sorted((r.keyword, r.search_count) for r in found) == [("", 3), (word + "a", 3), (word + "b", 6)]
    assert len({r.lead_uid for r in found}) == 3
    long = "".join(f"{k} " for k in range(900)) + "end"
    enquiries = spark.createDataFrame([(1, 2, 3, "quote", long, "NL", long, None)], "id long, enquiry_user_id long, seller_user_id long, "
                                      "enquiry_type string, message string, country string, competitor string, deleted_at timestamp").selectExpr(
        "*", "4 AS product_id", "'tiles' AS industry")
    assert platform_leads.enquiry_leads(enquiries, known).first().message == long
    rival = platform_leads.competitor_leads(enquiries, known).first()
    assert (rival.message, rival.current_supplier) == (long, long)
    quotations = spark.createDataFrame([(1, "sent", long, 1.0)], "id long, status string, product_name string, total_cost double")
    assert platform_leads.quotation_leads(quotations, known).first().product_name == long


def test_profile_keeps_all_keywords_and_buttons(spark):
    day, names = dt.datetime(2024, 1, 1), [f"keyword number {k:04}" for k in range(700)]
    frames = {"sessions": "session_id string, user_id long, created_at timestamp, country string, device string", "clicks": "session_id string, element_type string",
              "scrolls": "session_id string, average double", "page_views": "session_id string, type string, product_id long, created_at timestamp, deleted_at timestamp",
              "searches": "user_id long, name string, searched_total long, created_at timestamp, deleted_at timestamp", "messages": "user_id long",
              "enquiries": "enquiry_user_id long, enquiry_type string, created_at timestamp, deleted_at timestamp",
              "rfqs": "user_id long, status string, created_at timestamp", "button_events": "user_id string, button_identity string, created_at timestamp"}
    given = {"searches": [(7, n, 1 + (k == 699), day, None) for k, n in enumerate(names)],
             "button_events": [("7", b, day) for b in behavior.BUTTON_WEIGHTS]}
    got = behavior.buyer_profiles(**{k: spark.createDataFrame(given.get(k, []), v) for k, v in frames.items()}, keywords=700).first()
    assert got.search_keywords == [names[699], *names[:699]] and got.searches_done == 701
    assert got.high_intent_detail.split("|") == sorted(f"{b}:1" for b in behavior.BUTTON_WEIGHTS)


def test_long_rows_have_their_own_signal_and_a_whole_payload(spark):
    data = [("x" * 1500 + "1", "y" * 20_000), ("x" * 1500 + "2", "y" * 20_000), ("x" * 1500 + "2", "y" * 20_000)]
    table = spark.createDataFrame(data, "body string, note string")
    got = signals.normalise_signals(table, "raw.notes", "page_view", "CRMSource", AS_OF).collect()
    assert len({r.signal_uid for r in got}) == len({r.source_record_id for r in got}) == 2
    assert sorted(tuple(json.loads(r.payload).values()) for r in got) == data
