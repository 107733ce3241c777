"""Event streams: reading, routing, deduplication, and the tables they keep up to date.

Events are JSON text lines ``{source row} + _source_table + _polled_at`` under a topic. State is
Spark's own (stateful aggregation); each micro-batch appends the rows that changed to a log folder
``batch=<n>`` (rewritten when a batch is repeated, so effects are exactly once), and ``current``
reads the latest row per key. Batch operators then run on the touched keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.functions.values import as_ts, choose, first_non_empty, lookup, text
from leadloom.operators.behavior import button_weight, element_weight
from leadloom.operators.platform_leads import RFQ_QUOTED, RFQ_SUBMITTED, VISIBILITY

# Topics, topic renames, fields that leave on each topic.
HANDLERS = {"crm.rfq_submitted": "rfq", "crm.shipments": "shipment", "crm.buyer_sessions": "session",
            "crm.buyer_clicks": "click", "crm.lead_updates": "lead_update"}
LEAD_TABLES = {"crm.deals": "deal", "crm.account_risk_flags": "risk_flag", "crm.crm_emails": "email",
               "crm.auto_quote_email_events": "email", "crm.account_identity": "identity", "crm.lead_master": "lead_master"}
TOPIC_RENAMES = {"crm.rfq": "crm.rfq_submitted", "crm.sessions": "crm.buyer_sessions", "crm.clicks": "crm.buyer_clicks",
                 "crm.leads": "crm.lead_updates"}
TOPIC_FIELDS = {
    "kg.switch_leads": ["lead_id", "buyer_name", "hs_code", "final_lead_score", "switch_probability", "lead_priority",
                        "stress_reason", "match_score", "buyer_monthly_volume", "recommended_action", "status"],
    "kg.trade_relationships": ["rel_id", "buyer_name", "supplier_name", "hs_code", "health_score", "health_status",
                               "total_shipments", "relationship_age_months", "last_shipment_date"],
    "kg.buyer_profiles": ["user_id", "behavioral_score", "total_sessions", "high_intent_score", "searches_done"],
    "kg.pipeline_runs": ["run_id", "label", "rows"],
}
EMAIL_UP, EMAIL_DOWN = ["open", "opened", "click", "clicked"], ["bounce", "bounced", "spam", "unsubscribed"]
EMAIL_GAIN, EMAIL_LOSS, SCORE_LOW, SCORE_HIGH = 5, -10, 10, 100


def read_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of text lines from files; a broker source has the same ``value`` column."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def parse_events(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines): fields by schema; a line that is no such JSON goes aside, the stream goes on."""
    with_bad = T.StructType(schema.fields + [T.StructField("_bad", T.StringType())])
    parsed = lines.select(F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("e"), "value")
    good = parsed.where("e is not null and e._bad is null").select("e.*").drop("_bad")
    return good, parsed.where("e is null or e._bad is not null").select("value")


def route_events(events: DataFrame) -> DataFrame:
    """One row per event and handler: by topic, then source table; a visit with an element is click and session."""
    table, button = F.col("_source_table"), text("button_identity")
    element = text("element_name")
    session = F.when((table == "crm.page_event_trackings") & (button != ""), F.array(F.lit("click"))).when(
        (table == "crm.page_visits") & (element != ""), F.array(F.lit("click"), F.lit("session"))).otherwise(
        F.array(F.lit("session")))
    lead = F.array(lookup(LEAD_TABLES, table, "lead"))
    handler = lookup(HANDLERS, F.col("topic"), "none")
    return events.withColumn("handler", F.explode(F.when(handler == "session", session).when(
        handler == "lead_update", lead).otherwise(F.array(handler)))).withColumn(
        "button_identity", F.when((F.col("handler") == "click") & (button == ""), element).otherwise(button))


def dedup_events(events: DataFrame, key: str = "event_key", at: str = "_polled_at", within: str = "1 day") -> DataFrame:
    """Repeated deliveries dropped by key. The watermark is on arrival time, so late event times do not matter."""
    return events.withWatermark(at, within).dropDuplicatesWithinWatermark([key])


def run_to_log(stream: DataFrame, log: str, checkpoint: str, mode: str = "update",
               after: Callable[[DataFrame, int], None] | None = None):
    """Processes all there is; every batch writes its changed rows to ``log/batch=<n>``."""
    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{log.rstrip('/')}/batch={batch}")
        if after is not None:
            after(rows, batch)
        # shuffle files of the batches before go when their plans are collected, for which a large heap waits too long
        rows.sparkSession.sparkContext._jvm.System.gc()
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return query


def current(spark: SparkSession, log: str, keys: Sequence[str]) -> DataFrame:
    """Latest row per key over all batches of a log (map-side combine, so hot keys do not matter)."""
    rows = spark.read.parquet(log)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def touched(spark: SparkSession, log: str, batch: int, key: str) -> DataFrame:
    return spark.read.parquet(f"{log.rstrip('/')}/batch={batch}").select(key).distinct()


def stream_profiles(events: DataFrame) -> DataFrame:
    """Per known user: sessions, clicks, intent and last activity, from routed events (update mode)."""
    user = first_non_empty("user_id")
    click = F.col("handler") == "click"
    weight = F.when(element_weight(F.col("element_type")) > 0, element_weight(F.col("element_type"))).otherwise(
        button_weight(F.col("button_identity")))
    rows = events.where(F.col("handler").isin("click", "session")).withColumn("user_id", user).where(
        F.col("user_id").isNotNull() & (F.col("user_id") != "0"))
    return rows.groupBy("user_id").agg(
        F.count_if(F.col("handler") == "session").alias("total_sessions"), F.count_if(click).alias("total_clicks"),
        F.coalesce(F.sum(F.when(click, weight)), F.lit(0)).cast("long").alias("high_intent_score"),
        F.max("_polled_at").alias("last_activity_at"))


def latest_status(events: DataFrame, source_ref: Column, at: str = "_polled_at") -> DataFrame:
    """Latest row per source_ref (update mode); ties by event key."""
    rows = events.withColumn("source_ref", source_ref)
    rest = [c for c in rows.columns if c != "source_ref"]
    return rows.groupBy("source_ref").agg(F.max_by(F.struct(*rest), F.struct(at, "event_key")).alias("r")).select("source_ref", "r.*")


def _lead(rows: DataFrame, kind: Column, score: Column) -> DataFrame:
    return rows.select("source_ref", F.concat(F.lit("classified:"), kind, F.lit(":"), F.col("source_ref")).alias("lead_uid"),
                       kind.alias("lead_type"), score.cast("long").alias("score_final"),
                       lookup(VISIBILITY, kind, "feed").alias("visibility_level"))


def rfq_status_leads(rows: DataFrame) -> DataFrame:
    """Leads from the latest state of RFQs and enquiries (``_source_table``, status, enquiry_type)."""
    enquiry = F.contains("_source_table", F.lit("enquir"))
    e, st = F.lower(text("enquiry_type")), F.lower(text("status"))
    kind = choose([(enquiry & (e == "quote"), "quote_ready"), (enquiry, "rfq_submitted"), (st.isin(*RFQ_QUOTED), "quote_ready"),
                   (st.isin(*RFQ_SUBMITTED), "rfq_submitted")], "rfq_draft")
    score = choose([(enquiry & (e == "quote"), 90), (enquiry & (e == "bid"), 88), (enquiry, 85), (st.isin(*RFQ_QUOTED), 90),
                    (st.isin(*RFQ_SUBMITTED), 85)], 65)
    return _lead(rows, kind, score)


def lead_update_leads(rows: DataFrame) -> DataFrame:
    """Leads from the latest state of CRM leads (status, message)."""
    st, message = F.lower(text("status")), text("message")
    won = st.isin("converted", "won", "closed_won")
    kind = choose([(won, "quote_ready"), (message != "", "known_account_interest"), (st != "", "engaged_account")],
                  "known_person_interest")
    return _lead(rows, kind, choose([(won, 90), (message != "", 68), (st != "", 70)], 68))


def deal_leads(rows: DataFrame) -> DataFrame:
    return _lead(rows, F.lit("engaged_account"), F.lit(70))


def suppress_accounts(leads: DataFrame, flags: DataFrame) -> DataFrame:
    """Leads with every lead of a flagged account suppressed; the smallest risk type is the reason."""
    hit = flags.where(text("account_uid") != "").groupBy("account_uid").agg(F.min("risk_type").alias("_risk"))
    joined = leads.join(hit, "account_uid", "left")
    now = F.col("_risk").isNotNull() & (F.col("lead_type") != "suppressed_noise") & ~F.coalesce("suppressed", F.lit(False))
    return joined.withColumns({
        "suppressed": F.coalesce("suppressed", F.lit(False)) | now,
        "suppression_reason": F.when(now, F.col("_risk")), "seller_visible": F.when(now, False).otherwise(F.col("seller_visible")),
        "distribution_status": F.when(now, "suppressed").otherwise(F.col("distribution_status"))}).drop("_risk")


def copy_account_fields(leads: DataFrame, identities: DataFrame, masters: DataFrame) -> DataFrame:
    """Identity confidence by account and CRM status by lead copied onto leads (latest rows, one per key)."""
    ident = identities.select("account_uid", F.col("confidence_score").cast("double").alias("identity_confidence"),
                              F.col("organization_name").alias("org_name_resolved"))
    master = masters.select("lead_uid", F.col("status").alias("crm_status"), F.col("score_final").cast("double").alias("crm_score"),
                            F.col("is_suppressed"))
    return leads.join(ident, "account_uid", "left").join(master, "lead_uid", "left")


def email_scores(leads: DataFrame, emails: DataFrame) -> DataFrame:
    """Lead scores after their e-mail events in order, +5 or -10 each, kept within 10..100 after each.

    Adding d and then clamping to lo..hi is a function (d, lo, hi); two in a row are again one:
    lo and hi of the first move by the second's d and are clamped by the second. So events are
    folded per lead and minute, then the minutes of a day, then the days; no fold holds a whole
    history.
    """
    kind = F.lower(text("event_type"))
    steps = emails.withColumn("d", choose([(kind.isin(*EMAIL_UP), EMAIL_GAIN), (kind.isin(*EMAIL_DOWN), EMAIL_LOSS)], None))
    low, high = F.lit(SCORE_LOW).cast("long"), F.lit(SCORE_HIGH).cast("long")
    steps = steps.where("d is not null").select(
        "lead_uid", F.to_date("at").alias("day"), F.date_trunc("minute", "at").alias("minute"), F.struct("at", "event_id", F.col("d").cast("long").alias("d"),
                                                         low.alias("lo"), high.alias("hi")).alias("f"))

    def clamp(x: Column, f: Column) -> Column:
        return F.least(f["hi"], F.greatest(f["lo"], x + f["d"]))

    def fold(items: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("d"), F.lit(-1_000_000).cast("long").alias("lo"),
                         F.lit(1_000_000).cast("long").alias("hi"))
        return F.aggregate(F.array_sort(items), start, lambda a, f: F.struct(
            (a["d"] + f["d"]).alias("d"), clamp(a["lo"], f).alias("lo"), clamp(a["hi"], f).alias("hi")))
    folded = steps
    for keys in (["lead_uid", "day", "minute"], ["lead_uid", "day"], ["lead_uid"]):
        folded = folded.groupBy(*keys).agg(fold(F.collect_list("f")).alias("g"))
        if len(keys) > 1:  # the key that goes away is the order of the next fold
            folded = folded.select(*keys[:-1], F.struct(F.col(keys[-1]).alias("at"), "g.d", "g.lo", "g.hi").alias("f"))
    total = folded
    joined = leads.join(total, "lead_uid", "left")
    return joined.withColumn("score_final", F.coalesce(clamp(F.col("score_final").cast("long"), F.col("g")), "score_final")).drop("g")


def activity_windows(events: DataFrame, kind: str, size: str = "1 day", slide: str = "6 hours", gap: str = "30 minutes",
                     late: str | None = None) -> DataFrame:
    """Event counts and value per user in tumbling, sliding or session windows; ``late`` sets a watermark."""
    rows = events if late is None else events.withWatermark("ts", late)
    at = F.col("ts")
    window = {"tumbling": lambda: F.window(at, size), "sliding": lambda: F.window(at, size, slide),
              "session": lambda: F.session_window(at, gap)}[kind]()
    return rows.groupBy("user_id", window.alias("w")).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value")).select(
        "user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events", "value")


def publish_events(rows: DataFrame, topic: str, key: str, event_type: str, as_of) -> DataFrame:
    """Keyed JSON messages of one topic with its listed fields only."""
    fields = [c for c in TOPIC_FIELDS[topic] if c in rows.columns]
    body = F.struct(F.lit(event_type).alias("event_type"), F.date_format(as_ts(as_of), "yyyy-MM-dd'T'HH:mm:ss").alias("event_time"),
                    *[F.col(c) for c in fields])
    return rows.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"), F.to_json(body).alias("value"))


def cdc_route(changes: DataFrame, outbox_table: str = "etl.kg_outbox") -> DataFrame:
    """Topic of each change: tables renamed by the map, outbox rows to ``kg.<event type>`` with their payload as value."""
    table = F.col("table_name")
    is_outbox = table == outbox_table
    return changes.select(
        F.when(is_outbox, F.concat(F.lit("kg."), F.col("event_type"))).otherwise(F.coalesce(lookup(TOPIC_RENAMES, table), table)).alias("topic"),
        F.when(is_outbox, F.col("aggregate_id")).otherwise(F.col("row_key")).alias("key"),
        F.when(is_outbox, F.col("payload")).otherwise(F.col("row_json")).alias("value"))
