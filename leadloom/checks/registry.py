"""One list of checked queries: how Spark computes each, and which SQL piece must agree with it.

The column list of a query is given once, as text, and applied to both sides, so types and
rounding are the same: ``name`` as is, ``name:d`` double rounded to 6 places, ``name:i`` whole
number, ``name:s`` text, ``name:l`` array joined by commas.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.checks.compose import Inputs, with_statement


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Inputs], DataFrame]
    columns: str
    piece: str | None


def _split(columns: str) -> list[tuple[str, str]]:
    parts = [c.strip().partition(":") for c in columns.split(",") if c.strip()]
    return [(name, kind) for name, _, kind in parts]


def shape(df: DataFrame, columns: str) -> DataFrame:
    def one(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "d":
            c = F.round(c.cast("double"), 6)
        elif kind == "i":
            c = c.cast("long")
        elif kind == "s":
            c = c.cast("string")
        elif kind == "l":
            c = F.array_join(c, ",")
        return c.alias(name)
    return df.select(*[one(n, k) for n, k in _split(columns)]) if columns else df


def shape_sql(columns: str, piece: str) -> str:
    def one(name: str, kind: str) -> str:
        form = {"d": "round(CAST({0} AS DOUBLE), 6)", "i": "CAST({0} AS BIGINT)", "s": "CAST({0} AS VARCHAR)",
                "l": "array_to_string({0}, ',')"}.get(kind, "{0}")
        return f'{form.format(name)} AS {name}'
    return f"SELECT {', '.join(one(n, k) for n, k in _split(columns))} FROM {piece}"


class Registry:
    def __init__(self, pieces: dict[str, str]):
        self.pieces = pieces
        self.queries: dict[str, Query] = {}

    def add(self, name: str, run: Callable[[Inputs], DataFrame], columns: str, piece: str | None = "") -> None:
        """``piece`` defaults to the query's own name; None marks a query SQL cannot state."""
        if name in self.queries:
            raise ValueError(f"query {name} registered twice")
        self.queries[name] = Query(name, run, columns, name if piece == "" else piece)

    def callables(self, inputs: Callable[..., Inputs]):
        def bind(query: Query):
            return lambda spark, folder: shape(query.run(inputs(spark, folder)), query.columns)
        return {name: bind(q) for name, q in self.queries.items()}

    def sql(self) -> dict[str, str]:
        return {name: with_statement(q.piece, self.pieces, shape_sql(q.columns, q.piece))
                for name, q in self.queries.items() if q.piece is not None}
