"""Keyed merge, surrogate keys and audit columns: table upkeep without a table format.

The operators are pure (old, new -> merged); ``sources.sinks`` writes the result beside the old
table. Concurrent writers of one table are out of scope.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.functions.values import as_ts
from leadloom.session import staged

CREATED = ("created_on", "created_by")
KEPT_ON_UPDATE = (*CREATED, "ingested_at")
AUDIT = ("created_on", "created_by", "modified_on", "modified_by")


def audit_columns(df: DataFrame, as_of, by: str) -> DataFrame:
    now = as_ts(as_of)
    return df.withColumns({"created_on": now, "created_by": F.lit(by), "modified_on": now, "modified_by": F.lit(by)})


def _same_key(keys: Sequence[str]) -> Column:
    """Keys equal those of a side that calls them ``_k_...``; null is a key like any other."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])


def _keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_k_{k}") for k in keys])


def keyed_merge(old: DataFrame, new: DataFrame, keys: Sequence[str], as_of=None, by: str | None = None,
                update: Sequence[str] | None = None, keep: Sequence[str] = KEPT_ON_UPDATE) -> DataFrame:
    """Old rows with the listed columns replaced where the key comes again, plus the new keys.

    ``keep`` columns are never overwritten; modified_on/by are set on update when ``as_of`` is
    given. A key that occurs twice in ``new`` raises: which row should win is the caller's to say.
    Null keys equal each other.
    """
    keys = list(keys)
    columns = list(old.columns) + [c for c in new.columns if c not in old.columns]
    update = [c for c in (update if update is not None else new.columns) if c not in keys and c not in keep]
    left = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in old.columns if c not in keys],
                      F.lit(True).alias("_in_old"))
    right = new.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*[F.col(c) for c in new.columns])).alias("_r"))
    joined = left.join(right, _same_key(keys), "full_outer")
    # a filter, not a column: it runs whichever columns a reader asks for
    joined = joined.where(F.when(F.col("_n") > 1, F.raise_error(F.lit("duplicate key in merge source")).cast("boolean"))
                          .otherwise(F.lit(True)))
    is_new, matched = F.col("_in_old").isNull(), F.col("_in_old").isNotNull() & F.col("_n").isNotNull()

    def value(name: str) -> Column:
        before = F.col(f"_o_{name}") if name in old.columns else F.lit(None)
        after = F.col(f"_r.{name}") if name in new.columns else F.lit(None)
        if name == "modified_on" and as_of is not None:
            return F.when(matched | is_new, as_ts(as_of)).otherwise(before)
        if name == "modified_by" and by is not None:
            return F.when(matched | is_new, F.lit(by)).otherwise(before)
        if name in update:
            return F.when(F.col("_n").isNotNull(), after).otherwise(before)
        return F.when(is_new, after).otherwise(before)

    def key(name: str) -> Column:  # in one of the sides it may be null
        return F.when(is_new, F.col(f"_k_{name}")).otherwise(F.col(name))

    return joined.select(*[(key(c) if c in keys else value(c)).alias(c) for c in columns])


def surrogate_key(rows: DataFrame, name: str, order: Sequence[str], existing: DataFrame | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Gap-free keys 1..n (or after the largest in ``existing``) in the order of unique columns ``order``.

    No window over the whole table: rows are range-partitioned by the order, written once with
    their partition number (so a retry cannot move a row), counted per partition, and numbered
    inside the partition after the sum of the counts before it. Without ``partitions`` Spark joins
    neighbouring small ranges, so a small table is not written as many tiny files.
    """
    placed = rows.repartitionByRange(*([partitions] if partitions else []), *order)
    placed = staged(placed.withColumn("_p", F.spark_partition_id()), "ranges")
    counts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("n"))
    if existing is not None:
        counts = counts.unionByName(existing.agg(F.coalesce(F.max(name), F.lit(0)).cast("long").alias("n")).select(
            F.lit(-1).alias("_p"), "n"))
    # One row per partition: small enough for a single task and for a broadcast.
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("_p").orderBy(*order)
    return placed.join(F.broadcast(offsets), "_p").withColumn(
        name, (F.col("_before") + F.row_number().over(inside)).cast("long")).select(name, *rows.columns)


def gold_upsert(gold: DataFrame, silver: DataFrame, key_name: str, natural_key: Sequence[str],
                order: Sequence[str], update: bool = True, keep: Sequence[str] = KEPT_ON_UPDATE) -> DataFrame:
    """Silver into gold: new natural keys get the next surrogate keys, known ones keep theirs.

    ``update=False`` appends new rows only. A natural key with nulls is known again on the next run.
    """
    known_keys = _keys_of(gold, natural_key)
    fresh = silver.join(known_keys, _same_key(natural_key), "left_anti")
    numbered = surrogate_key(fresh.select(*silver.columns), key_name, order, existing=gold)
    kept = gold
    if update:
        known = silver.join(known_keys, _same_key(natural_key), "left_semi")
        kept = keyed_merge(gold, known, natural_key, keep=keep)
    return kept.unionByName(numbered.select(*gold.columns), allowMissingColumns=True)
