"""Data-quality checks.  Each returns a DataFrame of violations (empty = pass)
or a small summary; none collects the data it checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, null_count)`` for every column in ``cols``, in one scan."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``cols``."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def row_count_outside(df: DataFrame, low: int, high: int) -> DataFrame:
    """One row ``(row_count)`` when the count is outside ``[low, high]``, else none."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).where(~F.col("row_count").between(low, high))


def source_summary(df: DataFrame, entity: str = "country") -> DataFrame:
    """Total rows and distinct entities."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(entity).alias("distinct_countries"))


def range_violations(df: DataFrame, col: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows whose value lies outside ``[low, high]`` (NULL passes)."""
    c = F.col(col)
    cond = F.lit(False)
    if low is not None:
        cond = cond | (c < low)
    if high is not None:
        cond = cond | (c > high)
    return df.where(cond)


def relationship_violations(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose non-NULL key has no match in the dimension."""
    d = dim.select(F.col(dim_key).alias(fact_key)).distinct()
    return facts.where(F.col(fact_key).isNotNull()).join(d, fact_key, "left_anti")


def column_name_report(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, has_dot)`` for every column (schema only)."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), "." in f.name) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string, has_dot boolean")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows, for eyeballing a source."""
    return df.limit(n)


_NTH = "_nth_"


def watched(
    df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = ()
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], Observation]:
    """Checks that are counted while ``df`` is written, without a scan of their own.

    Returns the frame to hand to a writer, what the writer must apply to the
    rows just before it writes them, and the observation that holds
    ``{check name: failures}`` when it has.  Failures are rows with a NULL, or
    keys that occur more than once.
    """
    seen, marks = Observation(), {}
    metrics = [F.count_if(F.col(c).isNull()).alias(f"not_null_{c}") for c in not_null]
    for i, keys in enumerate(unique):
        # A key that repeats has exactly one second row.
        marks[f"{_NTH}{i}"] = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
        metrics.append(F.count_if(F.col(f"{_NTH}{i}") == 2).alias("unique_" + "_".join(keys)))
    marked = df.withColumns(marks) if marks else df
    return marked, lambda rows: rows.observe(seen, *metrics).drop(*marks), seen


def check_report(spark: SparkSession, seen: Mapping[str, Observation]) -> DataFrame:
    """``(model, check_name, failures)`` of the checks of written models, a row for each."""
    rows = [(m, name, n) for m, o in seen.items() for name, n in o.get.items()]
    return spark.createDataFrame(rows, "model string, check_name string, failures long")
