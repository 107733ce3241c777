"""Keyed JSON messages of four topics, and a sink that takes them exactly once.

``keyed_messages`` is a data source for batch and stream writers. Tasks write files of their own; on commit one small file
per batch names them, moved into place as the last step. A batch whose tasks failed leaves files no commit names; a batch that is
delivered again finds its commit and drops its new files. Readers see committed files only, and of a topic and key the
latest message. The folder may be in any file system pyarrow opens that all executors reach.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from leadloom.functions.values import as_ts

# Event type, key and fields (with the column each comes from) of the topics.
TOPICS = {
    "kg.switch_leads": ("switch_lead.upserted", "lead_id", {
        "lead_id": "lead_id", "buyer_name": "buyer_name", "buyer_org_id": "buyer_id", "buyer_country": "buyer_country", "buyer_industry": "buyer_industry",
        "current_supplier_name": "existing_supplier_name", "recommended_supplier_name": "candidate_supplier_name",
        "recommended_supplier_id": "candidate_supplier_id", "hs_code": "hs_code", "final_lead_score": "final_lead_score",
        "switch_probability": "switch_probability", "lead_priority": "lead_priority", "stress_reason": "stress_reason", "match_score": "match_score",
        "buyer_monthly_volume": "buyer_monthly_volume", "contact_name": "contact_name", "contact_title": "contact_title",
        "contact_email": "contact_email", "recommended_action": "recommended_action", "status": "status", "created_at": "created_at"}),
    "kg.trade_relationships": ("trade_relationship.health_updated", "rel_id", {
        "rel_id": "rel_id", "buyer_org_id": "buyer_id", "buyer_name": "buyer_name", "supplier_org_id": "supplier_id", "supplier_name": "supplier_name",
        "hs_code": "hs_code", "health_score": "health_score", "health_status": "health_status", "baseline_monthly_qty": "baseline_avg_qty",
        "total_shipments": "total_shipments", "relationship_age_months": "relationship_age_months", "last_shipment_date": "last_shipment_date",
        "updated_at": "updated_at"}),
    "kg.buyer_profiles": ("buyer_profile.score_updated", "user_id", {
        "user_id": "user_id", "org_id": "org_id", "behavioral_score": "behavioral_score", "session_count": "total_sessions",
        "click_intent_score": "high_intent_score", "scroll_depth_avg": "max_scroll_depth", "search_count": "searches_done",
        "last_active_date": "last_activity_at"}),
    "kg.pipeline_runs": ("pipeline.run_completed", "run_id", {"run_id": "run_id", "label": "label", "rows": "rows"}),
}
MESSAGE = "topic string, key string, value string"


def messages(rows: DataFrame, topic: str, as_of) -> DataFrame:
    """topic, key, value (JSON): one message per row with the topic's fields; what the rows lack is null."""
    event, key, fields = TOPICS[topic]
    have = {c.lower() for c in rows.columns}

    def one(name: str, source: str) -> Column:
        return (F.col(source) if source.lower() in have else F.lit(None).cast("string")).alias(name)
    time = F.date_format(as_ts(as_of), "yyyy-MM-dd'T'HH:mm:ss")
    body = F.struct(F.lit(event).alias("event_type"), time.alias("event_time"), *[one(n, s) for n, s in fields.items()])
    return rows.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"),
                       F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


@dataclass
class _Part(WriterCommitMessage):
    file: str | None
    rows: int


class _Files:
    """The two steps of a write. ``batch`` names the commit."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _at(self):
        from pyarrow import fs
        if "://" not in self.path and not self.path.startswith("file:"):
            return fs.LocalFileSystem(), self.path
        return fs.FileSystem.from_uri(self.path)

    def write(self, rows: Iterator[Row]) -> _Part:
        files, root = self._at()
        name, count, out = f"{uuid.uuid4().hex}.jsonl", 0, None
        for row in rows:
            if out is None:
                files.create_dir(f"{root}/parts", recursive=True)
                out = files.open_output_stream(f"{root}/parts/{name}")
            out.write((json.dumps({"topic": row["topic"], "key": row["key"], "value": row["value"], "place": count}, ensure_ascii=False) + "\n").encode())
            count += 1
        if out is None:
            return _Part(None, 0)
        out.close()
        return _Part(name, count)

    def commit(self, parts: list[_Part | None], batch: str) -> None:
        from pyarrow import fs
        files, root = self._at()
        files.create_dir(f"{root}/commits", recursive=True)
        place = f"{root}/commits/{batch}.json"
        if files.get_file_info(place).type != fs.FileType.NotFound:
            self.abort(parts)  # delivered again
            return
        draft = f"{root}/draft-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            for part in parts:
                if part and part.file:
                    out.write((json.dumps({"batch": batch, "file": part.file, "rows": part.rows}) + "\n").encode())
        files.move(draft, place)

    def abort(self, parts: list[_Part | None]) -> None:
        files, root = self._at()
        for part in parts:
            if part and part.file:
                files.delete_file(f"{root}/parts/{part.file}")


class _StreamWriter(DataSourceStreamWriter):
    def __init__(self, path: str, source: str):
        self.files, self.source = _Files(path), source

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        return self.files.write(iterator)

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803 (the base class's name)
        self.files.commit(messages, f"{self.source}-{batchId:012d}")

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.files.abort(messages)


class _Writer(DataSourceWriter):
    def __init__(self, path: str, batch: str):
        self.files, self.batch = _Files(path), batch

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        return self.files.write(iterator)

    def commit(self, messages: list) -> None:
        self.files.commit(messages, self.batch)

    def abort(self, messages: list) -> None:
        self.files.abort(messages)


class KeyedMessages(DataSource):
    """Options: ``path``; ``source`` names a stream among others (default ``stream``); ``batch`` names a batch write, whose
    repetition changes nothing. Commits count in the order of their names."""

    @classmethod
    def name(cls) -> str:
        return "keyed_messages"

    def schema(self) -> str:
        return MESSAGE

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamWriter:  # noqa: N802
        return _StreamWriter(self.options["path"], self.options.get("source", "stream"))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], self.options["batch"])


def publish(rows: DataFrame, path: str, batch: str) -> None:
    """Messages of a batch job; publishing the same ``batch`` again changes nothing."""
    rows.sparkSession.dataSource.register(KeyedMessages)
    rows.select("topic", "key", "value").write.format("keyed_messages").mode("append").option("path", path).option("batch", batch).save()


def publish_stream(rows: DataFrame, path: str, checkpoint: str, source: str = "stream"):
    """Messages of a stream, all there is now; returns the finished query."""
    rows.sparkSession.dataSource.register(KeyedMessages)
    query = rows.select("topic", "key", "value").writeStream.format("keyed_messages").option("path", path).option("source", source).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def published(spark: SparkSession, path: str) -> DataFrame:
    """All committed messages: topic, key, value, batch, file, place."""
    root = path.rstrip("/")
    commits = spark.read.schema("batch string, file string").json(f"{root}/commits")
    parts = spark.read.schema(f"{MESSAGE}, place long").json(f"{root}/parts")
    named = parts.withColumn("file", F.substring_index(F.input_file_name(), "/", -1))
    return named.join(commits, "file")


def latest_messages(spark: SparkSession, path: str) -> DataFrame:
    """topic, key, value: the latest message of every key; within a batch the last of a file."""
    order = F.struct("batch", "file", "place")
    return published(spark, path).groupBy("topic", "key").agg(F.max_by("value", order).alias("value"))
