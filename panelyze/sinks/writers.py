"""Writers: CSV, Parquet, year-partition replacement, tables over files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from panelyze.operators.ordinals import write_in_order


def write_csv(df: DataFrame, path: str, skip_empty: bool = True) -> bool:
    """Header CSV (no index column).  An empty frame writes nothing when
    ``skip_empty``; returns whether files were written."""
    if skip_empty and df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_parquet(df: DataFrame, path: str) -> None:
    """Parquet, replacing whatever is at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_years(df: DataFrame, path: str, year_col: str = "year", sort_by: Sequence[str] = ()) -> None:
    """Replace only the year partitions present in ``df``; other years stay.

    Dynamic partition overwrite: a reload of one year rewrites that year's
    folder and nothing else.  Rows are sorted within each task by the year
    and ``sort_by`` (clustering for min/max skipping) without a shuffle, so
    a year with many rows is still written by many tasks.
    """
    out = df.sortWithinPartitions(year_col, *sort_by)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(year_col)
        .parquet(path)
    )


Watch = Callable[[DataFrame], DataFrame]


def _unwatched(df: DataFrame) -> DataFrame:
    return df


def write_partitioned_clustered(
    df: DataFrame, path: str, partition_col: str, cluster_by: Sequence[str], watch: Watch = _unwatched
) -> None:
    """Full rewrite partitioned by ``partition_col``, clustered by ``cluster_by``.

    Rows are dealt by ranges of both, sized by AQE from their bytes, so a
    file holds one range of keys, the files of a partition do not overlap, and
    a filter on a key opens the files that can hold it.  The overwrite is
    static whatever the session says: partitions that the new frame lacks go.
    ``watch`` sees the rows as they are written (see ``quality.watched``).
    """
    keys = [partition_col, *cluster_by]
    dealt = df.repartitionByRange(*keys) if cluster_by else df
    # Behind the exchange, whose ranges are found by a run over a sample.
    out = watch(dealt.sortWithinPartitions(*keys)).write.mode("overwrite")
    out.option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(path)


def write_ordered(df: DataFrame, path: str, order: Sequence) -> None:
    """Globally ordered output; ``ordinals.read_in_order`` reads it with each row's place."""
    write_in_order(df, path, order)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, sort_by: Sequence[str] = ()) -> DataFrame:
    """Managed table hashed by ``key`` into ``buckets``, each sorted by the key and ``sort_by``.

    Windows, aggregations and joins on the key then need no exchange.  Rows
    are dealt like the buckets first, so each bucket is one file.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *sort_by).saveAsTable(name)
    return df.sparkSession.table(name)


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> DataFrame:
    """External table over Parquet files (schema read from the files)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def save_as_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Managed table (a materialised model)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A lazy model, registered by name."""
    df.createOrReplaceTempView(name)
    return df
