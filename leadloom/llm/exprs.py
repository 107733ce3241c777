"""Small column expressions shared by the operators that stay inside Spark SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Runs of other characters than space and ``\\t\\n\\v\\f\\r``; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that starts with ``name`` and that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
