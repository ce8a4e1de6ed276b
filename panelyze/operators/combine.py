"""Merging panels from several sources on ``(entity, period)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_KEYS = ("country", "year")


def suffix_collisions(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    suffixes: tuple[str, str] = ("_wb", "_ct"),
) -> tuple[DataFrame, DataFrame]:
    """Rename non-key columns present on both sides to ``name+suffix``."""
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    ls, rs = suffixes
    left = left.withColumnsRenamed({c: f"{c}{ls}" for c in shared}) if shared else left
    right = right.withColumnsRenamed({c: f"{c}{rs}" for c in shared}) if shared else right
    return left, right


def merge_panels(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    how: str = "full",
    suffixes: tuple[str, str] = ("_wb", "_ct"),
    null_safe: bool = False,
) -> DataFrame:
    """Outer-merge two panels on ``keys`` with collision suffixes.

    Key columns appear once (coalesced from both sides).  With
    ``null_safe=True`` NULL keys match each other, as in a dataframe-library
    merge; SQL semantics (the default) never match NULL keys.

    The merge is a single sort-merge (or broadcast) join; when both inputs
    come out of an aggregation on the same keys they are already partitioned
    on them and Spark adds no further exchange.
    """
    keys = list(keys)
    left, right = suffix_collisions(left, right, keys, suffixes)
    if not null_safe:
        return left.join(right, keys, how)
    l = left.alias("_l")
    r = right.alias("_r")
    cond = None
    for k in keys:
        c = F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}"))
        cond = c if cond is None else cond & c
    joined = l.join(r, cond, how)
    key_cols = [F.coalesce(F.col(f"_l.{k}"), F.col(f"_r.{k}")).alias(k) for k in keys]
    rest = [F.col(f"_l.{c}") for c in left.columns if c not in keys] + [
        F.col(f"_r.{c}") for c in right.columns if c not in keys
    ]
    return joined.select(*key_cols, *rest)


def merge_with_fallbacks(
    left: DataFrame | None,
    right: DataFrame | None,
    keys: Sequence[str] = DEFAULT_KEYS,
    empty_columns: Sequence[str] = DEFAULT_KEYS,
    suffixes: tuple[str, str] = ("_wb", "_ct"),
    has_rows: tuple[bool, bool] | None = None,
) -> DataFrame:
    """Merge, using whichever side has rows when the other is missing or empty.

    ``None`` stands for a source that has no files.  When both are absent a
    typed empty frame with ``empty_columns`` (strings) is returned.
    ``has_rows`` says which side has rows where that is known (for written
    tables see ``sources.files.footer_rows``); otherwise a job looks for one
    row of each side.
    """
    known = has_rows or tuple(df is not None and not df.isEmpty() for df in (left, right))
    has_left, has_right = (df is not None and has for df, has in zip((left, right), known))
    if has_left and has_right:
        return merge_panels(left, right, keys, "full", suffixes)
    if has_left:
        return left
    if has_right:
        return right
    spark = (left or right).sparkSession if (left or right) is not None else None
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
    schema = ", ".join(f"`{c}` string" for c in empty_columns)
    return spark.createDataFrame([], schema)


def restrict_to_dim(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Facts whose key is in the dimension (only fact columns are kept).

    A left-semi join: equal to an inner join when the dimension key is
    unique, and never duplicates facts when it is not.  No broadcast hint:
    a dimension of entities can be large, so the planner (and AQE, from
    runtime sizes) decides.
    """
    return facts.join(dim.select(F.col(dim_key).alias(fact_key)), fact_key, "left_semi")


def enrich(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Add dimension attributes by key (inner or left)."""
    d = dim.select(F.col(dim_key).alias(fact_key), *cols)
    return facts.join(d, fact_key, how)


def join_single_period(left: DataFrame, right: DataFrame, entity: str = "country", period: str | None = None) -> DataFrame:
    """Inner join on the entity only, for inputs that each hold one period.

    Names that both sides have get suffixes.  Inputs of several periods would
    multiply rows: name their ``period`` column and the join is made for every
    period that both hold, each as if it stood alone.
    """
    same = [entity]
    if period:
        right = right.withColumn("_period", F.col(period))
        left = left.withColumn("_period", F.col(period))
        same.append("_period")
    left, right = suffix_collisions(left, right, same, ("_1", "_2"))
    return left.join(right, same, "inner").drop("_period")
