"""Deterministic keys as native column expressions (no Python UDF, so codegen stays intact)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(part: Column | str) -> Column:
    return F.col(part) if isinstance(part, str) else part


def stable_id(*parts: Column | str) -> Column:
    """First 32 hex digits of SHA-256 over ``len:value`` segments joined by NUL.

    A null part counts as the empty string; lengths are in characters. Strings name
    columns, literals go in as ``F.lit``.
    """
    segments = []
    for part in parts:
        value = F.coalesce(_col(part).cast("string"), F.lit(""))
        segments.append(F.concat(F.length(value).cast("string"), F.lit(":"), value))
    return F.substring(F.sha2(F.concat_ws("\0", *segments), 256), 1, 32)


def hash_key(*parts: Column | str, lower: bool = False) -> Column:
    """SHA-256 over the parts joined by a bar; a null part is '' so positions are kept."""
    values = [F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]
    if lower:
        values = [F.lower(v) for v in values]
    return F.sha2(F.concat_ws("|", *values), 256)


def bucket_of(text: Column | str, buckets: int = 100) -> Column:
    """Stable bucket of a category text, equal in every process."""
    digest = F.md5(F.lower(F.coalesce(_col(text), F.lit(""))))
    return F.pmod(F.conv(F.substring(digest, 1, 7), 16, 10).cast("long"), F.lit(buckets)).cast("long")
