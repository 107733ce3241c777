"""Turns named SQL pieces into one WITH statement, and fixture pieces into DataFrames.

A piece is SQL text that names other pieces or base tables as ``{name}``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from leadloom.session import staged

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")
SHARED = ("shipments",)  # joins of the largest tables that several other fixtures read
_REF = re.compile(r"\{(\w+)\}")


def references(sql: str) -> list[str]:
    return list(dict.fromkeys(_REF.findall(sql)))


def with_statement(name: str, pieces: dict[str, str], final: str | None = None) -> str:
    """The SQL of piece ``name`` with everything it needs in front of it as common table expressions."""
    done: list[str] = []

    def visit(piece: str) -> None:
        if piece in BASE_TABLES or piece in done:
            return
        for ref in references(pieces[piece]):
            visit(ref)
        done.append(piece)

    visit(name)
    ctes = ",\n".join(f"{p} AS ({_REF.sub(r'\1', pieces[p])})" for p in done)
    word = "WITH RECURSIVE" if any("RECURSIVE" in pieces[p] for p in done) else "WITH"
    return f"{word} {ctes}\n{final or f'SELECT * FROM {name}'}"


class Inputs:
    """Base tables of one scale-factor folder and the fixtures built on them."""

    def __init__(self, spark: SparkSession, folder: str, pieces: dict[str, str]):
        self.spark, self.folder, self.pieces = spark, folder, pieces
        self._seen: dict[str, DataFrame] = {}
        self._written: set[str] = set()

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._seen:
            if name in BASE_TABLES:
                frame = self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")
            else:
                sql = self.pieces[name]
                frame = self.spark.sql(sql, **{r: self._once(r) if r in SHARED else self[r] for r in references(sql)})
            self._seen[name] = frame
        return self._seen[name]

    def _once(self, name: str) -> DataFrame:
        """A fixture computed and written once for all that read it from here on."""
        if name not in self._written:
            self._written.add(name)
            self._seen[name] = staged(self[name], name)
        return self._seen[name]
