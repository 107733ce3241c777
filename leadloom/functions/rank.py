"""Per-key choice of rows that survives hot keys.

``row_number`` over a hot key sorts that whole key in one task. The functions here use
aggregates with map-side combine instead, so a key that holds a third of all rows only
sends one partial row per map task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the largest by ``order``; remaining columns break ties, largest first.

    Nulls count as smallest, so a row with a value beats a row without one.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [o.alias(f"_o{i}") for i, o in enumerate(order)] + [F.col(c) for c in rest]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_b"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_b.{c}").alias(c) for c in df.columns])


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, salts: int = 64) -> DataFrame:
    """The k smallest rows of every key by ``order``, with their 1-based ``rank``.

    Two levels: k per (key, salt) first, so the last window sees at most ``k * salts`` rows
    of one key. Exact, because the k smallest overall are among the k smallest of their salt.
    """
    from pyspark.sql import Window

    ordered = df.withColumns({f"_o{i}": o for i, o in enumerate(order)})
    marks = [f"_o{i}" for i in range(len(order))]
    ordered = ordered.withColumn("_salt", F.pmod(F.xxhash64(*marks), F.lit(salts)))
    by = [F.col(m) for m in marks]
    local = Window.partitionBy(*keys, "_salt").orderBy(*by)
    final = Window.partitionBy(*keys).orderBy(*by)
    return (
        ordered.withColumn("_r", F.row_number().over(local)).where(F.col("_r") <= k)
        .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
        .drop("_r", "_salt", *marks)
    )
