"""Sellers: statistics, ranking, lead assignment, credits."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.config import Distribution
from leadloom.functions.rank import top_k
from leadloom.functions.values import as_ts, choose, lookup, text, tidy_round
from leadloom.operators.merge import surrogate_key
from leadloom.session import staged

# Ranking weights, answer times by visibility, credit costs, tiers.
WEIGHTS = {"fit": 0.30, "lane": 0.15, "win": 0.20, "response": 0.15, "capacity": 0.10, "relationship": 0.10}
SLA_HOURS = {"instant_alert": 4, "push_notify": 24, "priority": 48, "feed": 168, "watchlist": 720, "count_only": 9999}
CREDIT_COST = {"critical": 5, "high": 3, "medium": 1, "low": 0}
TIER_ACCESS = {"basic": ["low", "medium"], "professional": ["low", "medium", "high"],
               "enterprise": ["low", "medium", "high", "critical"]}
DEFAULT_SLA, DEFAULT_RESPONSE, ANY = 168, 48.0, "*"
PRIORITY_ORDER = ("critical", "high", "medium", "low")


def seller_stats(sellers: DataFrame, assignments: DataFrame, conversions: DataFrame) -> DataFrame:
    """Per seller: assigned, converted, win rate, mean response hours (48 when unknown).

    Both sides are counted before they meet, so the counts do not multiply.
    """
    given = assignments.groupBy("seller_id").agg(F.count(F.lit(1)).alias("a"), F.avg("response_hours").alias("h"))
    won = conversions.groupBy("seller_id").agg(F.count(F.lit(1)).alias("c"))
    rows = sellers.select("seller_id").join(given, "seller_id", "left").join(won, "seller_id", "left")
    a, c = F.coalesce("a", F.lit(0)), F.coalesce("c", F.lit(0))
    return rows.select("seller_id", a.alias("total_assigned"), c.alias("total_converted"),
                       F.when(a > 0, c / a).otherwise(0.0).alias("win_rate"),
                       F.coalesce("h", F.lit(DEFAULT_RESPONSE)).alias("avg_response_h"))


def _chapter(code: Column) -> Column:
    return F.substring(F.regexp_replace(text(code), r"[\[\]\s]", ""), 1, 2)


def _markets(sellers: DataFrame) -> DataFrame:
    """Seller rows per (chapter, country) they serve; '*' where they are open. A listed chapter '*' is no chapter of a lead."""
    def served(col: str) -> Column:
        wide = F.col(col).isNull() | (F.size(col) == 0) | F.array_contains(col, ANY)
        return F.explode(F.when(wide, F.array(F.lit(ANY))).otherwise(F.array_distinct(col)))
    rows = sellers.withColumn("m_chapter", F.explode(F.when(
        F.col("hs_chapters").isNull() | (F.size("hs_chapters") == 0), F.array(F.lit(ANY))).otherwise(
        F.array_remove(F.array_distinct("hs_chapters"), ANY))))
    return rows.withColumn("m_country", served("target_countries"))


def _demand(leads: DataFrame) -> DataFrame:
    return leads.withColumns({"hs_chapter": _chapter(F.col("hs_code")), "country": F.upper(text("buyer_country"))})


def _blocks() -> Column:
    """The four markets a lead belongs to: its own and the open ones."""
    return F.explode(F.array_distinct(F.array(*[F.struct(ch.alias("m_chapter"), co.alias("m_country"))
                                                for ch in (F.col("hs_chapter"), F.lit(ANY)) for co in (F.col("country"), F.lit(ANY))])))


def rank_score(sla: Column) -> Column:
    """Six-part seller score for one kind of lead; needs seller, statistics and lead-kind columns."""
    chapters, countries = F.col("hs_chapters"), F.col("target_countries")
    near = F.exists(chapters, lambda ch: (F.length(ch) > 0) & F.startswith(F.col("hs_chapter"), F.substring(ch, 1, 1)))
    fit = choose([(chapters.isNull() | (F.size(chapters) == 0), 0.5),
                  (F.array_contains(chapters, F.col("hs_chapter")), 1.0), (near, 0.6)], 0.0)
    lane = choose([(countries.isNull() | (F.size(countries) == 0) | F.array_contains(countries, ANY), 0.5),
                   (F.array_contains(countries, F.col("country")), 1.0)], 0.0)
    win = F.least(F.coalesce("win_rate", F.lit(0.0)) * 2.5, F.lit(1.0))
    hours = F.coalesce("avg_response_h", F.lit(DEFAULT_RESPONSE))
    answer = choose([(hours <= sla * 0.25, 1.0), (hours <= sla * 0.5, 0.75), (hours <= sla, 0.5)], 0.1)
    daily = F.col("max_leads_per_day")
    room = F.least(F.greatest(F.lit(0), daily - F.col("leads_today")) / F.greatest(daily, F.lit(1)), F.lit(1.0))
    depth = F.least(F.coalesce("total_assigned", F.lit(0)) / 100.0, F.lit(1.0))
    parts = {"fit": fit, "lane": lane, "win": win, "response": answer, "capacity": room, "relationship": depth}
    return tidy_round(sum(WEIGHTS[k] * v for k, v in parts.items()), 4)


def _wanted(leads: DataFrame) -> DataFrame:
    """The kinds of leads with each of the markets they belong to."""
    kinds = _demand(leads).select("hs_chapter", "country", F.coalesce("visibility", F.lit("")).alias("visibility")).distinct()
    return kinds.select("*", _blocks().alias("b")).select("hs_chapter", "country", "visibility", "b.*")


def _market_scores(leads: DataFrame, sellers: DataFrame, stats: DataFrame) -> DataFrame:
    """(m_chapter, m_country, visibility, seller_id, rank_score): sellers of each market that leads belong to. In a market a
    seller fits every lead alike: by its own chapter and country or by being open. Markets are of closed lists, sellers are not."""
    markets = _wanted(leads).select("m_chapter", "m_country", "visibility").distinct()
    pairs = F.broadcast(markets).join(_markets(sellers.join(stats, "seller_id", "left")), ["m_chapter", "m_country"])
    pairs = pairs.withColumns({"hs_chapter": F.col("m_chapter"), "country": F.col("m_country")})
    return pairs.withColumn("rank_score", rank_score(lookup(SLA_HOURS, F.col("visibility"), DEFAULT_SLA))).select(
        "m_chapter", "m_country", "visibility", "seller_id", "rank_score")


def rank_sellers(leads: DataFrame, sellers: DataFrame, stats: DataFrame, k: int | None = None) -> DataFrame:
    """Eligible sellers ranked per kind of lead (chapter, country, visibility), best ``k`` (None: all).

    The score depends on a lead only through its visibility and the market in which a seller serves it, so it is computed per
    market and seller and not per lead and seller; leads look their kind up.
    """
    scored = _wanted(leads).join(_market_scores(leads, sellers, stats), ["m_chapter", "m_country", "visibility"]).select(
        "hs_chapter", "country", "visibility", "seller_id", "rank_score")
    keys, order = ["hs_chapter", "country", "visibility"], [-F.col("rank_score"), F.col("seller_id")]
    if k is not None:
        return top_k(scored, keys, order, k)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def _cost(priority: Column) -> Column:
    return lookup(CREDIT_COST, priority, 0)


def _class_of(priority: Column) -> Column:
    return choose([(priority == p, n) for n, p in enumerate(PRIORITY_ORDER[:3], start=1)], 4)


def pending_leads(leads: DataFrame, assignments: DataFrame | None = None) -> DataFrame:
    """Leads to hand out: visible to sellers, not blocked, not distributed before (by their own mark or by an assignment)."""
    rows = leads.where(F.coalesce("seller_visible", F.lit(False)) & (F.coalesce("distribution_status", F.lit("pending")) == "pending")
                       & (F.coalesce("lead_type", F.lit("")) != "blocked"))
    return rows if assignments is None else rows.join(assignments.select("lead_id").distinct(), "lead_id", "left_anti")


def mark_distributed(leads: DataFrame, assignments: DataFrame, as_of) -> DataFrame:
    """The leads after an assignment: those that went to a seller are distributed since ``as_of``."""
    went = assignments.select("lead_id").distinct().withColumn("_went", F.lit(True))
    now = F.coalesce("_went", F.lit(False))
    before = F.col("distributed_at") if "distributed_at" in leads.columns else F.lit(None).cast("timestamp")
    return leads.join(went, "lead_id", "left").withColumns({
        "distribution_status": F.when(now, "distributed").otherwise(F.col("distribution_status")),
        "distributed_at": F.when(now, as_ts(as_of)).otherwise(before)}).drop("_went")


def assign_leads(leads: DataFrame, sellers: DataFrame) -> DataFrame:
    """Every seller takes leads by priority and score while capacity and credits last; leads are shared.

    Sellers do not affect each other, so each one's take is a closed form: of priority class c
    ``min(leads, credits / cost, capacity)``, then the next class with what is left. A seller needs
    no more leads of a class than its capacity, so only the first ``capacity`` leads of each market
    (chapter, country, priority) are ranked for it: no lead x seller table is built.
    """
    most = sellers.agg(F.max(F.col("max_leads_per_day") - F.col("leads_today"))).first()[0] or 0
    if most <= 0:
        most = 1
    offered = _demand(leads).select(
        "lead_id", "priority", F.col("score").cast("double").alias("score"), "hs_chapter", "country",
        _class_of(F.col("priority")).alias("class"), _blocks().alias("b")).select(
        "lead_id", "priority", "score", "hs_chapter", "country", "class", "b.*")
    first = top_k(offered, ["m_chapter", "m_country", "class"], [-F.col("score"), F.col("lead_id")], int(most)).drop("rank")
    free = sellers.where("active").withColumn("capacity", F.greatest(
        F.lit(0), F.col("max_leads_per_day") - F.col("leads_today")))
    pairs = _markets(free).join(first, ["m_chapter", "m_country"])
    per_class = Window.partitionBy("seller_id", "class").orderBy(F.desc("score"), "lead_id")
    pairs = pairs.withColumn("n", F.row_number().over(per_class))
    counts = pairs.groupBy("seller_id").agg(
        F.first("capacity").alias("cap"), F.first("credits_available").cast("double").alias("cr"),
        *[F.count_if(F.col("class") == c).alias(f"n{c}") for c in (1, 2, 3, 4)])
    for c, priority in enumerate(PRIORITY_ORDER, start=1):
        cost = CREDIT_COST[priority]
        affordable = F.floor(F.col("cr") / cost) if cost else F.when(F.col("cr") >= 0, F.col("cap")).otherwise(0)
        counts = counts.withColumn(f"a{c}", F.greatest(F.lit(0), F.least(F.col(f"n{c}"), affordable, F.col("cap"))))
        counts = counts.withColumns({"cr": F.col("cr") - F.col(f"a{c}") * cost, "cap": F.col("cap") - F.col(f"a{c}")})
    allowed = choose([(F.col("class") == c, F.col(f"a{c}")) for c in (1, 2, 3)], F.col("a4"))
    taken = pairs.join(counts.select("seller_id", "a1", "a2", "a3", "a4"), "seller_id").where(F.col("n") <= allowed)
    return taken.select(
        F.concat(F.lit("sla:"), "seller_id", F.lit(":"), "lead_id").alias("assignment_id"), "seller_id", "lead_id",
        "priority", _match_reason().alias("match_reason"), _cost(F.col("priority")).cast("long").alias("credits_cost"))


def _match_reason() -> Column:
    parts = F.concat_ws(
        ",", F.when(F.size("hs_chapters") > 0, F.concat(F.lit("hs_"), F.col("hs_chapter"))),
        F.when(F.size("target_countries") > 0, F.concat(F.lit("geo_"), F.col("country"))))
    return F.coalesce(F.nullif(parts, F.lit("")), F.lit("open_match"))


SLICE = 1_000_000  # most leads of a slice, on average


def _serve(per_lead: int):
    """One slice of leads served in their order, given the sellers' room at its start: (slice, g, seller).

    A kind of lead is the markets it belongs to; its list of sellers is their merged lists, read only as far as sellers fill up.
    Holds the leads of the slice and the sellers that are still open.
    """
    def run(leads: pa.Table, offers: pa.Table) -> pa.Table:
        leads = leads.sort_by("g")
        offers = offers.sort_by([(c, "ascending") for c in ("list", "place", "seller")])
        number, place = offers["list"].to_numpy(), offers["place"].to_numpy()
        sellers, seller = np.unique(offers["seller"].to_numpy(), return_inverse=True)
        room = np.zeros(len(sellers), "int64")
        room[seller] = offers["room"].to_numpy()
        room = room.tolist()

        def market(one: int) -> Iterator[tuple[float, int]]:
            begin, end = np.searchsorted(number, [one, one + 1])
            for at in range(begin, end, 256):
                yield from zip(place[at:min(at + 256, end)].tolist(), seller[at:min(at + 256, end)].tolist())

        kinds = leads["lists"].combine_chunks().dictionary_encode()
        state = [([], heapq.merge(*[market(int(n)) for n in name.split(",")])) for name in kinds.dictionary.to_pylist()]
        lead, got = [], []
        for g, kind in zip(leads["g"].to_numpy().tolist(), kinds.indices.to_numpy().tolist()):
            if state[kind] is None:
                continue
            taken, rest = state[kind]
            if not taken or any(room[s] <= 0 for s in taken) or len(taken) < per_lead:
                taken[:] = [s for s in taken if room[s] > 0]
                while len(taken) < per_lead and (found := next(rest, None)) is not None:
                    if room[found[1]] > 0 and found[1] not in taken:
                        taken.append(found[1])
                if not taken:
                    state[kind] = None
                    continue
            for s in taken:
                room[s] -= 1
            lead += [g] * len(taken)
            got += taken
        at = leads["slice"][0].as_py() if len(leads) else 0
        return pa.table({"slice": pa.array([at] * len(lead), "int32"), "g": pa.array(lead, "int64"), "seller": pa.array(sellers[got] if got else [], "int64")})
    return run


def _room_before(budget: DataFrame, todo: Column, class_of: Column, used: DataFrame) -> DataFrame:
    """(slice, seller, room): what each seller still takes at the start of each slice in ``todo``, after what the slices before used."""
    asked = budget.select("seller", F.explode(todo).alias("slice"), "cap", "cr", F.lit(0).cast("long").alias("n"))
    gone = used.select("seller", "slice", *[F.lit(None).cast(budget.schema[c].dataType).alias(c) for c in ("cap", "cr")], "n")
    before = Window.partitionBy("seller").orderBy("slice").rangeBetween(Window.unboundedPreceding, -1)
    rows = asked.unionByName(gone).withColumn("class", class_of)
    rows = rows.withColumns({f"u{n}": F.coalesce(F.sum(F.when(F.col("class") == n, F.col("n"))).over(before), F.lit(0))
                             for n in range(1, len(PRIORITY_ORDER) + 1)}).where("cap IS NOT NULL")
    cap, cr = F.col("cap"), F.col("cr")
    rooms = []
    for n, priority in enumerate(PRIORITY_ORDER, start=1):
        cost = CREDIT_COST[priority]
        paid = F.floor(cr / cost) if cost else F.when(cr >= 0, cap).otherwise(0)
        rooms.append((F.col("class") == n, F.least(cap, paid).cast("long") - F.col(f"u{n}")))
        cap, cr = cap - F.col(f"u{n}"), cr - F.col(f"u{n}") * cost
    return rows.select("slice", "seller", choose(rooms[:-1], rooms[-1][1]).alias("room")).where("room > 0")


def _assign_in_turn(leads: DataFrame, sellers: DataFrame, offers: DataFrame, kind_of: Sequence[str], per_lead: int) -> DataFrame:
    """Leads by priority class, score and id; each takes the first ``per_lead`` sellers of its markets' lists, ``offers`` by
    ``place`` and seller_id, that have capacity and credits left. A seller that is listed twice is one seller.

    The leads are cut into slices of their order, none across two classes. All slices are served at once, each from the room
    that the slices before it left by the last round's account; a slice is settled when those before it are and have used what it
    was told. A round settles the first open slice at least, so there are no more rounds than slices; what is settled equals
    serving one by one. A task holds one slice and the offers of open sellers, one row per seller and market. Tables that grow
    with the sellers or the leads are merged, as their files are far smaller than they are in the driver's memory.
    """
    market = [c for c in offers.columns if c not in ("seller_id", "place")]
    budget = sellers.groupBy("seller_id").agg(F.max((F.col("max_leads_per_day") - F.col("leads_today")).cast("long")).alias("cap"),
                                              F.max(F.col("credits_available").cast("double")).alias("cr"))
    budget = staged(surrogate_key(budget.where("cap > 0 AND seller_id IS NOT NULL"), "seller", ["seller_id"]), "budget")
    lists = staged(surrogate_key(offers.select(*market).distinct(), "list", market), "lists")
    offers = staged(offers.join(lists, market).join(budget.select("seller_id", "seller").hint("merge"), "seller_id").groupBy("list", "seller").agg(
        F.min("place").alias("place")), "offers")
    rows = _demand(leads).withColumn("visibility", text("visibility")).select(
        "lead_id", "priority", *dict.fromkeys(("hs_chapter", "country", *kind_of)), _class_of(F.col("priority")).alias("class"),
        (-F.col("score").cast("double")).alias("s"))
    rows = staged(surrogate_key(rows, "g", ["class", "s", "lead_id"]), "ordered")
    kinds = rows.select(*kind_of).distinct().select("*", _blocks().alias("b")).select(*kind_of, "b.*").join(lists, market).groupBy(
        *kind_of).agg(F.concat_ws(",", F.array_sort(F.collect_list("list")).cast("array<string>")).alias("lists"))

    slices, cut = [], F.lit(0)
    for c, first, n in sorted(rows.groupBy("class").agg(F.min("g"), F.count(F.lit(1))).collect()):  # one row per class
        parts = ceil(n / SLICE)
        cut = F.when(F.col("class") == c, len(slices) + F.floor((F.col("g") - first) * parts / n)).otherwise(cut)
        slices += [c] * parts  # the class of each slice
    turn = staged(rows.join(kinds, list(kind_of)).select(cut.cast("int").alias("slice"), "g", "lists"), "turn")
    class_of = F.element_at(F.array(*[F.lit(c) for c in slices]), F.col("slice") + 1)
    used = budget.where("1 = 0").select(F.lit(0).alias("slice"), "seller", F.lit(0).alias("class"), F.lit(0).cast("long").alias("n"))
    done, settled = [], -1
    while settled + 1 < len(slices):
        left, later = len(slices) - settled - 1, F.col("slice") > settled
        todo = F.array(*[F.lit(n) for n in range(settled + 1, len(slices))])
        open_now = _room_before(budget, todo, class_of, used).join(offers.hint("merge"), "seller")
        served = staged(turn.where(later).repartition(left, "slice").groupBy("slice").cogroup(
            open_now.repartition(left, "slice").groupBy("slice")).applyInArrow(_serve(per_lead), "slice int, g long, seller long"), "served")
        if left == 1:  # nothing after it depends on its account
            done.append(served)
            break
        now = served.groupBy("slice", "seller").agg(F.count(F.lit(1)).alias("n")).withColumn("class", class_of)
        now = staged(used.where(~later).unionByName(now), "used")
        told = used.where(later).withColumn("n", -F.col("n")).unionByName(now.where(later))
        changed = told.groupBy("slice", "seller").agg(F.sum("n").alias("n")).where("n <> 0").agg(F.min("slice")).first()[0]
        done.append(served if changed is None else served.where(F.col("slice") <= changed))
        settled, used = len(slices) - 1 if changed is None else changed, now

    done = reduce(DataFrame.unionByName, done, rows.where("1 = 0").select(F.lit(0).alias("slice"), "g", F.col("g").alias("seller")))
    out = rows.select("lead_id", "hs_chapter", "country", "priority")
    got = done.hint("merge").join(rows.select("g", "lead_id", "priority"), "g").join(
        budget.select("seller", "seller_id").hint("merge"), "seller").select("lead_id", "seller_id", _cost(F.col("priority")).cast("long").alias("cost"))
    out = out.join(got.hint("merge"), "lead_id").join(sellers.select("seller_id", "hs_chapters", "target_countries").hint("merge"), "seller_id")
    return out.select(F.concat(F.lit("sla:"), "seller_id", F.lit(":"), "lead_id").alias("assignment_id"), "seller_id",
                      "lead_id", "priority", _match_reason().alias("match_reason"), F.col("cost").alias("credits_cost"))


def assign_exclusive(leads: DataFrame, sellers: DataFrame, stats: DataFrame) -> DataFrame:
    """As ``assign_leads``, but a lead goes to one seller only: its best-ranked one with room."""
    live = sellers.where("active")
    offers = _market_scores(leads, live, stats).select("m_chapter", "m_country", "visibility", "seller_id", (-F.col("rank_score")).alias("place"))
    return _assign_in_turn(leads, live, offers, ("hs_chapter", "country", "visibility"), 1)


def assign_switch_leads(leads: DataFrame, sellers: DataFrame, cfg: Distribution = Distribution()) -> DataFrame:
    """As ``assign_leads`` over switch leads: at most three sellers per lead, in seller_id order."""
    live = sellers.where("active")
    offers = _markets(live).select("m_chapter", "m_country", "seller_id", F.lit(0.0).alias("place"))
    return _assign_in_turn(leads, live, offers, ("hs_chapter", "country"), cfg.switch_leads_per_lead)


def reset_daily_counts(sellers: DataFrame, as_of) -> DataFrame:
    """leads_today back to 0 for sellers whose count is from another day."""
    today = as_ts(as_of).cast("date")
    same = F.coalesce(F.col("leads_today_date") == today, F.lit(False))
    return sellers.withColumns({"leads_today": F.when(same, F.col("leads_today")).otherwise(0).cast("long"),
                                "leads_today_date": today})


def upsert_sellers(old: DataFrame, given: DataFrame, cfg: Distribution = Distribution()) -> DataFrame:
    """Sellers after an update: the given value, else the old one, else the default."""
    joined = old.alias("o").join(given.alias("g"), F.col("o.seller_id") == F.col("g.seller_id"), "full_outer")
    defaults = {"tier": F.lit("basic"), "credits_available": F.lit(0.0), "active": F.lit(True),
                "max_leads_per_day": F.lit(cfg.max_leads_per_day).cast("long")}

    def pick(name: str) -> Column:
        tries = [F.col(f"g.{name}")] if name in given.columns else []
        tries += [F.col(f"o.{name}")] if name in old.columns else []
        return F.coalesce(*tries, *([defaults[name]] if name in defaults else [])).alias(name)
    return joined.select(*[pick(c) for c in old.columns])


LEDGER = "seller_id string, credits_available double, credits_used double, refused long"


def credit_ledger(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Balances after ordered deducts and top-ups; a deduct beyond the balance is refused.

    Accounts that never run short are settled by sums (per seller and day, then per seller: sums
    and lowest running balances add up in any grouping). Only accounts that do run short need the
    order; they are read as a sorted stream with a running balance, never held in memory. A
    monthly total of -1 means unlimited.
    """
    delta = F.when(F.col("kind") == "topup", F.col("amount")).otherwise(-F.col("amount"))
    moves = transactions.withColumns({"delta": delta, "day": F.to_date("at")})
    in_day = Window.partitionBy("seller_id", "day").orderBy("at", "tx_id")
    days = moves.withColumn("run", F.sum("delta").over(in_day.rowsBetween(Window.unboundedPreceding, 0))).groupBy(
        "seller_id", "day").agg(F.sum("delta").alias("total"), F.min("run").alias("low"), F.sum(
            F.when(F.col("kind") == "deduct", F.col("amount")).otherwise(0)).alias("used"))
    before = Window.partitionBy("seller_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    sellers = days.withColumn("at_low", F.coalesce(F.sum("total").over(before), F.lit(0.0)) + F.col("low")).groupBy(
        "seller_id").agg(F.sum("total").alias("total"), F.min("at_low").alias("low"), F.sum("used").alias("used"))
    state = accounts.join(sellers, "seller_id", "left").na.fill(0.0, ["total", "low", "used"])
    unlimited = F.col("credits_total_month") == -1
    short = ~unlimited & (F.col("credits_available") + F.col("low") < 0)
    easy = state.where(~short).select(
        "seller_id", F.when(unlimited, F.col("credits_available") + F.col("total") + F.col("used")).otherwise(
            F.col("credits_available") + F.col("total")).alias("credits_available"),
        (F.col("credits_used_month") + F.col("used")).alias("credits_used"), F.lit(0).cast("long").alias("refused"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seller = None
        balance = used = 0.0
        refused = 0
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.seller_id != seller:
                    if seller is not None:
                        out.append((seller, balance, used, refused))
                    seller, balance, used, refused = row.seller_id, row.credits_available, row.credits_used_month, 0
                if row.kind == "topup":
                    balance += row.amount
                elif row.amount <= balance:
                    balance, used = balance - row.amount, used + row.amount
                else:
                    refused += 1
            if out:
                yield pd.DataFrame(out, columns=["seller_id", "credits_available", "credits_used", "refused"])
        if seller is not None:
            yield pd.DataFrame([(seller, balance, used, refused)],
                               columns=["seller_id", "credits_available", "credits_used", "refused"])

    hard = state.where(short).select("seller_id", F.col("credits_available").cast("double").alias("credits_available"),
                                     F.col("credits_used_month").cast("double").alias("credits_used_month"))
    ordered = moves.join(hard, "seller_id").select(
        "seller_id", "kind", F.col("amount").cast("double").alias("amount"), "at", "tx_id", "credits_available",
        "credits_used_month").repartition("seller_id").sortWithinPartitions("seller_id", "at", "tx_id")
    return easy.select("seller_id", F.col("credits_available").cast("double").alias("credits_available"),
                       F.col("credits_used").cast("double").alias("credits_used"), "refused").unionByName(
        ordered.mapInPandas(walk, LEDGER))


def billing_reset(accounts: DataFrame, as_of, days: int = 30) -> DataFrame:
    """A new month for accounts whose cycle is 30 days old: nothing used, the allotment available."""
    today = as_ts(as_of).cast("date")
    due = F.coalesce(F.datediff(today, F.col("billing_cycle_start")) >= days, F.lit(False))
    return accounts.withColumns({
        "credits_used_month": F.when(due, F.lit(0)).otherwise(F.col("credits_used_month")),
        "credits_available": F.when(due & (F.col("credits_total_month") != -1), F.col("credits_total_month")).otherwise(
            F.col("credits_available")),
        "billing_cycle_start": F.when(due, today).otherwise(F.col("billing_cycle_start"))})


def tier_access(leads: DataFrame, sellers: DataFrame) -> DataFrame:
    """Assigned (seller, lead) rows with whether the seller's tier may see the lead's priority."""
    allowed = choose([(F.col("tier") == t, F.array_contains(F.array(*[F.lit(p) for p in ps]), F.col("priority")))
                      for t, ps in TIER_ACCESS.items()], False)
    return leads.join(sellers.select("seller_id", "tier"), "seller_id").withColumn("accessible", allowed)

