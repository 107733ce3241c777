"""Where results go: warehouse appends, keyed node and edge tables, the outbox, the load log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.ids import stable_id
from leadloom.functions.rank import best_row
from leadloom.functions.values import as_ts
from leadloom.operators.merge import keyed_merge
from leadloom.sources.versioned import VersionedTable


def append_new_keys(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key the target lacks: what an append to the target must write."""
    return rows.join(target.select(key), key, "left_anti").select(*rows.columns)


def warehouse_shape(df: DataFrame, columns: Sequence[str], arrays: Sequence[str] = (),
                    structs: Sequence[str] = ()) -> DataFrame:
    """Fixed column order, arrays as comma text, nested values as JSON text."""
    def one(name: str) -> Column:
        if name in arrays:
            return F.concat_ws(",", F.col(name).cast("array<string>")).alias(name)
        return F.to_json(name).alias(name) if name in structs else F.col(name)
    return df.select(*[one(c) for c in columns])


def write_nodes(table: VersionedTable, rows: DataFrame, source: str = "", batch: int | None = None) -> int:
    """The node table's next version: known keys updated where a new value is there, unknown ones added, null keys left out."""
    rows = rows.where(F.col(table.keys[0]).isNotNull())
    return table.upsert(keyed_merge(table.near(rows), rows, table.keys, keep=()), source=source, batch=batch)


def write_edges(table: VersionedTable, rows: DataFrame, source: str = "", batch: int | None = None) -> int:
    """The edge table's next version (src, dst): every pair once, those with a missing end left out, known ones as they are."""
    pairs = rows.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).dropDuplicates(["src", "dst"])
    return table.upsert(pairs.join(table.near(pairs), ["src", "dst"], "left_anti"), source=source, batch=batch)


def unique_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """An edge table (src, dst) with every pair once; pairs with a missing end are left out."""
    ends = F.col("src").isNotNull() & F.col("dst").isNotNull()
    return old.unionByName(new.where(ends)).dropDuplicates(["src", "dst"])


# Event types and payload fields of the outbox.
SWITCH_LEAD_EVENT = "switch_lead.upserted"
RELATIONSHIP_EVENT = "trade_relationship.health_updated"
RUN_EVENT = "pipeline.run_completed"
RELATIONSHIP_FIELDS = ["rel_id", "buyer_id", "buyer_name", "supplier_id", "supplier_name", "hs_code", "health_score",
                       "health_status", "baseline_avg_qty", "total_shipments", "relationship_age_months",
                       "last_shipment_date"]
LEAD_FIELDS = ["lead_id", "buyer_name", "buyer_id", "hs_code", "candidate_supplier_name", "candidate_supplier_id",
               "final_lead_score", "switch_probability", "lead_priority", "stress_reason", "match_score",
               "buyer_monthly_volume", "contact_name", "contact_title", "contact_email", "recommended_action", "status"]


def outbox_events(rows: DataFrame, event_type: str, aggregate: str, fields: Sequence[str], as_of) -> DataFrame:
    """One unprocessed event per row with the listed fields as JSON.

    The id is derived from type and aggregate, so writing the same rows again changes nothing.
    """
    payload = F.to_json(F.struct(*[F.col(c) for c in fields if c in rows.columns]), {"ignoreNullFields": "false"})
    return rows.select(
        F.col(aggregate).cast("string").alias("aggregate_id"),
        stable_id(F.lit("outbox"), F.lit(event_type), F.col(aggregate)).alias("event_id"),
        F.lit(event_type).alias("event_type"), payload.alias("payload"),
        as_ts(as_of).alias("created_at"), F.lit(False).alias("processed"))


OUTBOX = "aggregate_id string, event_id string, event_type string, payload string, created_at timestamp, processed boolean"


def write_outbox(table: VersionedTable, events: DataFrame, source: str = "", batch: int | None = None) -> int:
    """The outbox after the events (``OUTBOX`` by aggregate_id): a later write of an aggregate replaces the earlier one and is
    unprocessed again. Of several events of an aggregate in one write the latest counts, then the last by type."""
    return table.upsert(best_row(events, ["aggregate_id"], [F.col("created_at"), F.col("event_type")]), source=source, batch=batch)


def mark_processed(table: VersionedTable, events: DataFrame) -> int:
    """Marks the events that were sent; one replaced meanwhile stays unprocessed."""
    sent = table.near(events).join(events.select("aggregate_id", "event_id", F.col("created_at").alias("sent_at")), ["aggregate_id", "event_id"])
    return table.upsert(sent.where("created_at = sent_at").drop("sent_at").withColumn("processed", F.lit(True)))


def load_log(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Feed log after these runs; the last success stays when a run fails.

    ``runs``: feed_name, run_at, records_loaded, status, error_msg, one per feed.
    """
    ok = F.col("status") == "success"
    merged = keyed_merge(log, runs.select(
        "feed_name", F.col("run_at").alias("last_run_at"), F.when(ok, F.col("run_at")).alias("_success"),
        "records_loaded", "status", "error_msg"), ["feed_name"], keep=())
    return merged.withColumn("last_success_at", F.coalesce(
        F.when(F.col("status") == "success", F.col("_success")), "last_success_at")).select(*log.columns)
