"""Equi joins whose keys differ widely in size: both sides' counts per key decide how a key is cut up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = 2_000  # most rows of a side, on average, in one part of a hot key
ROW, COLUMN = "_grid_row", "_grid_column"


def grid_sizes(left: DataFrame, right: DataFrame, keys: Sequence[str], cell: int = CELL) -> DataFrame:
    """The hot keys of either side with the grid they are cut into: ``_rows`` parts of the left side, ``_columns`` of the right."""
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l")).join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r")), list(keys), "full")
    counts = counts.where((F.coalesce("_l", F.lit(0)) > cell) | (F.coalesce("_r", F.lit(0)) > cell))

    def parts(count: str) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.coalesce(count, F.lit(0)) / cell)).cast("int")
    return counts.select(*keys, parts("_l").alias("_rows"), parts("_r").alias("_columns"))


def grid_sides(left: DataFrame, right: DataFrame, keys: Sequence[str], cell: int = CELL,
               spread: tuple[Sequence[str], Sequence[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with the sub-key (``ROW``, ``COLUMN``) of every row. Each row of a hot key takes one part of its own side and
    is copied to all parts of the other, so every pair meets in exactly one cell; rows of other keys are left alone.

    Rows are dealt by the hash of ``spread`` columns of each side (all of them by default); equal rows share a part. Rows
    with a null key meet nothing and are left out.
    """
    for key in keys:
        left, right = left.where(F.col(key).isNotNull()), right.where(F.col(key).isNotNull())
    sizes = grid_sizes(left, right, keys, cell)
    sides = spread or (left.columns, right.columns)

    def dealt(side: DataFrame, by: Sequence[str], own: str, other: str, mark: str, copied: str) -> DataFrame:
        part = F.pmod(F.xxhash64(*by), F.coalesce(own, F.lit(1))).cast("int")
        rows = side.join(sizes, list(keys), "left")
        return rows.withColumns({mark: part, copied: F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))}).drop("_rows", "_columns")

    return dealt(left, sides[0], "_rows", "_columns", ROW, COLUMN), dealt(right, sides[1], "_columns", "_rows", COLUMN, ROW)


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], cell: int = CELL, condition: Column | None = None,
              spread: tuple[Sequence[str], Sequence[str]] | None = None) -> DataFrame:
    """The inner equi join on ``keys``, however the rows are spread over them. Both sides should be written tables or cheap to
    compute twice, as their keys are counted first. Other columns must differ in name."""
    a, b = grid_sides(left, right, keys, cell, spread)
    joined = a.join(b, [*keys, ROW, COLUMN]).drop(ROW, COLUMN)
    return joined if condition is None else joined.where(condition)

