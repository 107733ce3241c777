"""Short text helpers for the DuckDB side of the checks."""

from __future__ import annotations


def sid(*exprs: str) -> str:
    """stable_id over SQL expressions."""
    parts = [f"concat(CAST(length(coalesce(CAST({e} AS VARCHAR), '')) AS VARCHAR), ':', coalesce(CAST({e} AS VARCHAR), ''))"
             for e in exprs]
    return "substr(sha256(concat(" + ", chr(0), ".join(parts) + ")), 1, 32)"


def words(expr: str, items) -> str:
    """Any of the words occurs in the lower-cased text."""
    return "(" + " OR ".join(f"contains(lower({expr}), '{w}')" for w in items) + ")"


def quoted(items) -> str:
    return ", ".join(f"'{i}'" for i in items)


def values_table(columns: str, rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + f") AS v({columns})"


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding of a double after dropping noise beyond 9 places."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 9)), {digits}) AS DOUBLE)"
