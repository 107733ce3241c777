"""Where knowledge came from: sources, touches, devices, anonymous visitors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.functions.ids import stable_id
from leadloom.functions.skew import grid_join
from leadloom.functions.values import text
from leadloom.session import staged

# Touch score, signal weight and event type by kind of source row.
TOUCH = {
    "page_visit": (1.0, 1.0, "page_view"),
    "rfq": (3.0, 4.0, "rfq_created"),
    "lead": (4.0, 4.0, "lead_created"),
    "thread": (3.0, 2.0, "thread_created"),
}
GHOST_CONFIDENCE = 0.55


def provenance_touches(kinds: dict[str, DataFrame]) -> DataFrame:
    """Source, event, touch and signal ids of every row (frames by kind with id, channel, at)."""
    out = None
    for kind, frame in kinds.items():
        score, weight, event = TOUCH[kind]
        ref = F.col("id").cast("string")

        def made(name: str, what: str = kind, key: Column = ref) -> Column:
            return stable_id(F.lit(name), F.lit(what), key)
        part = frame.select(
            F.lit(kind).alias("kind"), ref.alias("source_ref"), made("lead_source").alias("source_id"),
            made("provenance_event").alias("event_id"), made("touch").alias("touch_id"),
            made("signal", event).alias("signal_id"), F.lit(event).alias("event_type"),
            F.lower(F.trim(text("channel"))).alias("channel"), F.lit(score).alias("touch_score"),
            F.lit(weight).alias("signal_weight"), F.col("at").alias("event_at"))
        out = part if out is None else out.unionByName(part)
    return out


def device_identity(visits: DataFrame, sessions: DataFrame, owned: DataFrame) -> DataFrame:
    """Anonymous visitors: one per visited session no account owns and address, with ip, fingerprint and ghost profile ids."""
    seen = visits.where(F.trim(text("ip")) != "").select("session_id", F.trim("ip").alias("ip")).distinct()
    agents = sessions.select("session_id", F.col("user_agent").alias("ua"))
    rows = seen.join(agents, "session_id", "left").join(owned.select("session_id").distinct(), "session_id", "left_anti")
    visitor = stable_id(F.lit("anon_visitor"), F.col("session_id"))
    return rows.where("session_id is not null").select(
        "session_id", visitor.alias("visitor_id"), stable_id(F.lit("ip"), F.col("ip")).alias("ip_id"),
        stable_id(F.lit("fingerprint"), F.col("ip"), text("ua")).alias("fingerprint_id"),
        stable_id(F.lit("ghost_profile"), visitor).alias("profile_id"), F.lit(GHOST_CONFIDENCE).alias("confidence"))


def ip_identities(sessions: DataFrame, visits: DataFrame) -> DataFrame:
    """(ip_id, ip, source, last_seen): addresses of sessions and visits; where both know one, the visits say the rest."""
    def seen(rows: DataFrame, column: str, at: str, source: str, place: int) -> DataFrame:
        ip = F.trim(text(column))
        return rows.where(ip != "").groupBy(ip.alias("ip")).agg(F.max(at).alias("at")).select(
            "ip", F.struct(F.lit(place).alias("place"), F.lit(source).alias("source"), "at").alias("s"))
    both = seen(sessions, "ip_address", "last_activity", "ui", 0).unionByName(seen(visits, "ip", "seen_at", "crm", 1))
    return both.groupBy("ip").agg(F.max("s").alias("s")).select(
        stable_id(F.lit("ip"), F.col("ip")).alias("ip_id"), "ip", F.col("s.source").alias("source"), F.col("s.at").alias("last_seen"))


def session_addresses(sessions: DataFrame) -> DataFrame:
    """(session_id, ip_id): OBSERVED_AT_IP of sessions by their own address."""
    ip = F.trim(text("ip_address"))
    return sessions.where((ip != "") & F.col("session_id").isNotNull()).select("session_id", stable_id(F.lit("ip"), ip).alias("ip_id")).distinct()


def ghost_to_lead(ghosts: DataFrame, page_views: DataFrame, view_sources: DataFrame, lead_sources: DataFrame) -> DataFrame:
    """(profile_id, lead_id): a ghost's session has a page view whose source a lead shares.

    Pairs are made distinct before each join, so repeated views of one source do not multiply; a source is
    cut up by how many ghosts and leads share it. A lead of one source meets a ghost once; only the pairs of leads
    of several sources can come again and are made distinct.
    """
    sources = ghosts.select("profile_id", "session_id").join(page_views.select("session_id", "page_view_id"), "session_id").join(
        view_sources, "page_view_id").select("profile_id", "source_id").distinct()
    several = F.count(F.lit(1)).over(Window.partitionBy("lead_id")) > 1
    leads = staged(lead_sources.where("source_id IS NOT NULL").select("lead_id", "source_id").distinct().withColumn("several", several), "lead_sources")
    sources = staged(sources, "ghost_sources")
    met = [grid_join(sources, leads.where(part).drop("several"), ["source_id"]).select("profile_id", "lead_id") for part in ("NOT several", "several")]
    return met[0].unionByName(met[1].distinct())
