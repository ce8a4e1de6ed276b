"""Per-entity time-series windows and group statistics.

All entity windows partition by the entity key, never by period alone, so a
window never collapses into one task.  Statistics over a group that is large
by nature (all entities of one year, all members of a region) are computed
with ``groupBy`` (partial aggregation before the shuffle) and joined back
behind a size check (AQE's runtime one by default), not with a window over
the raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def entity_window(entity: str | Sequence[str], period: str) -> Window:
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(period)


def lag_value(value: str | Column, entity: str | Sequence[str], period: str, offset: int = 1) -> Column:
    """Value of the previous *available* row of the entity (gaps are skipped)."""
    return F.lag(value, offset).over(entity_window(entity, period))


def exact_lag_value(value: str | Column, entity: str | Sequence[str], period_num: str, n: int) -> Column:
    """Value at exactly ``period - n`` for the entity, NULL if that period is absent.

    ``period_num`` must be numeric (an integer year).  One range frame
    replaces a self-join on ``period = period + n``; it needs a unique
    ``(entity, period)`` key.
    """
    w = entity_window(entity, period_num).rangeBetween(-n, -n)
    return F.first(value).over(w)


def exact_lag_present(entity: str | Sequence[str], period_num: str, n: int) -> Column:
    """True when a row exists exactly ``n`` periods earlier."""
    w = entity_window(entity, period_num).rangeBetween(-n, -n)
    return F.count(F.lit(1)).over(w) > 0


def baseline_value(value: str | Column, entity: str | Sequence[str], period: str) -> Column:
    """Value at the entity's first period, attached to every row.

    Uses the same partition and order as ``lag_value`` so that Spark computes
    both in one window pass.
    """
    w = entity_window(entity, period).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.first(value).over(w)


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join a small derived table (group statistics) back to the rows.

    No hint is given: with AQE on, Spark measures ``small`` in bytes when its
    shuffle stage finishes and plans a broadcast join only below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, a sort-merge join
    above it.  Everything stays one job, so a subtree shared by both sides
    is computed once.
    """
    return big.join(small, list(on), how)


def attach_group_stats(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, Column],
    source: DataFrame | None = None,
) -> DataFrame:
    """Add group aggregates (e.g. the average of the row's region and year).

    The statistics are computed from ``source`` (default ``df``) with a
    partially aggregated ``groupBy`` and joined back with ``join_small``.
    Rows whose key has a NULL get NULL statistics, as with a SQL equi-join.
    """
    source = df if source is None else source
    stats = source.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    stats = stats.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    return join_small(df, stats, keys, "left")


def share_of_group_total(value: str | Column, group: Sequence[str]) -> Column:
    """``value / SUM(value) OVER (PARTITION BY group)`` as a fraction.

    Meant for rows that are already aggregated (a handful per group); for raw
    rows use ``attach_group_stats``.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.try_divide(v, F.sum(v).over(Window.partitionBy(*group)))


def rank_within(group: Sequence[str], order: Sequence[Column]) -> Column:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY order)``."""
    return F.row_number().over(Window.partitionBy(*group).orderBy(*order))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``<= k`` within each group.

    The filter sits directly on the row number, which lets Spark plan a
    partial per-partition top-k before the shuffle (WindowGroupLimit).
    """
    return df.withColumn(rank_col, rank_within(group, order)).where(F.col(rank_col) <= k)
