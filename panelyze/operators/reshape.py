"""Reshaping: long indicator records to wide rows, measure maps to columns,
and stacking frames whose columns differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_last(
    df: DataFrame,
    keys: Sequence[str],
    name_col: str,
    value_col: str,
    names: Sequence[str],
    order: Sequence[str | Column],
) -> DataFrame:
    """Long ``(keys, name, value)`` -> one row per ``keys``, one column per name.

    Rows with a NULL/empty key or a NULL value are skipped; when a key has
    several values for one name, the last in ``order`` wins.  ``names`` is
    the fixed list of output columns (no extra job to discover them), and
    the aggregation is partial before its shuffle.
    """
    ok = F.col(value_col).isNotNull() & F.col(name_col).isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull() & (F.col(k).cast("string") != F.lit(""))
    order_key = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return (
        df.where(ok)
        .groupBy(*keys)
        .pivot(name_col, list(names))
        .agg(F.max_by(F.col(value_col), order_key))
    )


def pivot_sum(df: DataFrame, keys: Sequence[str], name_col: str, value_col: str, names: Sequence[str]) -> DataFrame:
    """Like ``pivot_last`` but summing repeated values."""
    return df.where(F.col(value_col).isNotNull()).groupBy(*keys).pivot(name_col, list(names)).agg(F.sum(value_col))


def map_keys_of(df: DataFrame, map_col: str) -> list[str]:
    """The measure names that occur in a map column, sorted (one aggregation; a name is one row)."""
    names = df.select(F.explode(F.map_keys(map_col)).alias("name")).distinct().orderBy("name")
    return [r["name"] for r in names.collect()]


def flatten_map(df: DataFrame, key_col: str, map_col: str, measures: Sequence[str] | None = None) -> DataFrame:
    """A map of measures -> one column per measure.

    Without ``measures`` every name that occurs becomes a column.  Rows
    without a key or with an empty map are skipped.
    """
    m = F.col(map_col)
    ok = F.col(key_col).isNotNull() & (F.col(key_col).cast("string") != F.lit("")) & m.isNotNull() & (F.size(m) > 0)
    rows = df.where(ok)
    names = list(measures) if measures is not None else map_keys_of(rows, map_col)
    return rows.select(key_col, *[m.getItem(k).alias(k) for k in names])


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns missing in a frame become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
