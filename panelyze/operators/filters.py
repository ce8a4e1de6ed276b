"""Row filters.  Each is a plain ``where`` so Catalyst can push it to the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name patterns that mark a non-sovereign territory.
NON_SOVEREIGN_PATTERNS = ("%Territory%", "%Island%", "%Dependencies%", "%Dependency%")


def all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every column in ``cols`` is non-NULL."""
    return df.where(all_not_null(cols))


def not_like_any(c: str, patterns: Sequence[str]) -> Column:
    """``c NOT LIKE p1 AND c NOT LIKE p2 ...`` (case-sensitive; NULL drops the row)."""
    cond = F.lit(True)
    for p in patterns:
        cond = cond & ~F.col(c).like(p)
    return cond


def exclude_name_patterns(df: DataFrame, name_col: str, patterns: Sequence[str] = NON_SOVEREIGN_PATTERNS) -> DataFrame:
    return df.where(not_like_any(name_col, patterns))


def nonempty(c: str) -> Column:
    """``c IS NOT NULL AND c != ''``."""
    return F.col(c).isNotNull() & (F.col(c) != F.lit(""))


def positive(df: DataFrame, c: str | Column) -> DataFrame:
    """``c > 0``: drops NULL and non-positive values."""
    c = F.col(c) if isinstance(c, str) else c
    return df.where(c > 0)


def only_entity(df: DataFrame, entity_col: str, values: Sequence | object) -> DataFrame:
    if isinstance(values, (list, tuple, set, frozenset)):
        return df.where(F.col(entity_col).isin(list(values)))
    return df.where(F.col(entity_col) == F.lit(values))


def only_years(df: DataFrame, years: Sequence[int] | None, year_col: str = "year") -> DataFrame:
    """Restrict to a list of years; on a year-partitioned table this prunes files."""
    if not years:
        return df
    return df.where(F.col(year_col).isin(list(years)))
