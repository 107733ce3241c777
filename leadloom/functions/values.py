"""Small value helpers shared by the operators. All are native expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def non_empty(col: Column | str) -> Column:
    """The text with '' turned into null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(c.cast("string"), F.lit(""))


def first_non_empty(*cols: Column | str) -> Column:
    return F.coalesce(*[non_empty(c) for c in cols])


def first_present(df: DataFrame, names: Sequence[str], dtype: str = "string") -> Column:
    """First non-empty among those of ``names`` the frame has (any case); typed null when none."""
    have = {c.lower(): c for c in df.columns}
    cols = [non_empty(f"`{have[n.lower()]}`") for n in names if n.lower() in have]
    return (F.coalesce(*cols) if cols else F.lit(None)).cast(dtype)


def text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def norm(col: Column | str) -> Column:
    """Lower-cased, trimmed text: the join form of ids and names."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.trim(c.cast("string")))


def to_number(col: Column | str) -> Column:
    """Number from text with thousands commas; bad text becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.replace(c.cast("string"), F.lit(","), F.lit(""))).try_cast("double")


def parse_date(col: Column | str) -> Column:
    """First 10 characters as a date; bad text becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c.cast("string"), 1, 10).try_cast("date")


def parse_timestamp(col: Column | str) -> Column:
    """First 19 characters as a timestamp (blank or T between date and time); bad text is null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(F.substring(c.cast("string"), 1, 19), F.lit("T"), F.lit(" ")).try_cast("timestamp")


def as_ts(value) -> Column:
    """A clock argument (text, datetime or Column) as a timestamp column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour days between two timestamps, rounded down."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def choose(rules: Sequence[tuple[Column, object]], default) -> Column:
    """First rule that holds gives its value; a null condition does not hold."""
    out = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def lookup(table: Mapping[str, object], key: Column, default=None) -> Column:
    """Value of a short fixed table by key (literal map, no join needed)."""
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def tidy_round(col: Column, digits: int) -> Column:
    """Half-up rounding that first drops the noise of the last bits, so x.5 ties round alike everywhere."""
    return F.round(F.round(col, 9), digits)


def one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row frames with different columns put side by side (union and max, no cross join)."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def days_before(ts: Column, days: int) -> Column:
    return ts - F.make_dt_interval(days=F.lit(days))
