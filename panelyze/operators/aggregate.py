"""Group aggregations beyond a plain ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelyze.functions.numeric import exact_avg, exact_sum


def sum_by_key_zero_fill(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sum ``values`` by ``keys``; rows with a NULL key are dropped and an
    all-NULL group sums to 0 (dataframe-library semantics, unlike SQL).
    Sums are exact (see ``numeric.exact_sum``)."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[F.coalesce(exact_sum(v), F.lit(0.0)).alias(v) for v in values])
    )


def entity_summary(df: DataFrame, entity: str, total_col: str, share_col: str) -> DataFrame:
    """Per entity: sum of a total column and average of a share column."""
    return df.groupBy(entity).agg(
        exact_sum(total_col).alias("total_emissions"),
        exact_avg(share_col).alias(f"avg_{share_col}"),
    )


def count_labels(value: str | Column, labels: Sequence[str]) -> list[Column]:
    """``COUNT(CASE WHEN value = label THEN 1 END)`` for each label."""
    v = F.col(value) if isinstance(value, str) else value
    return [F.count(F.when(v == F.lit(lab), F.lit(1))) for lab in labels]


def mode_of_labels(counts: Sequence[Column], labels: Sequence[str]) -> Column:
    """Label with the highest count among a known label set.

    ``counts`` are per-label counts from the same aggregation (see
    ``count_labels``), so no extra shuffle or join is needed.  Ties go to the
    label that sorts last, NULL if all counts are 0.
    """
    pairs = [F.struct(c.alias("n"), F.lit(lab).alias("label")) for c, lab in zip(counts, labels)]
    top = F.greatest(*pairs) if len(pairs) > 1 else pairs[0]
    return F.when(top["n"] > 0, top["label"])


def mode_by_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent non-NULL ``value`` per group, for an open label set.

    Two aggregations, both partial before their shuffle: count per
    ``(keys, value)``, then ``max_by`` on ``(count, value)``; ties go to the
    larger value so the result is deterministic.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("_n", value)).alias(f"mode_{value}"))


def sample_values(df: DataFrame, keys: Sequence[str], value: str, n: int = 10, name: str | None = None) -> DataFrame:
    """Up to ``n`` smallest distinct values of ``value`` per group, as a sorted array.

    A filter on ``row_number() <= n`` lets Spark keep only the top ``n`` per
    group in each partition before the shuffle, so a large group never meets
    in one task.
    """
    name = name or f"sample_{value}"
    distinct = df.select(*keys, value).where(F.col(value).isNotNull()).distinct()
    w = Window.partitionBy(*keys).orderBy(value)
    top = distinct.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return top.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(name))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()
