"""Year tables in the catalog: partitions are added one reload at a time, and years are read from the catalog."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from panelyze.sources.files import partition_folders


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_year_table(spark: SparkSession, name: str, path: str, schema: str, year_col: str = "year") -> None:
    """An external table over ``path`` partitioned by ``year_col``, with no partition yet.

    ``schema`` gives all columns as DDL, so no file is opened for it.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({schema}) USING parquet "
        f"PARTITIONED BY ({year_col}) LOCATION {_text(path)}"
    )


def add_years(spark: SparkSession, name: str, folders: Mapping[int | str, str], year_col: str = "year") -> None:
    """Make the catalog know some years, each with its folder; a year that it knows moves there."""
    known = set(catalog_years(spark, name, year_col=year_col))
    for year, folder in folders.items():
        part = f"PARTITION ({year_col} = {int(year)})"
        if int(year) in known:
            spark.sql(f"ALTER TABLE {_quoted(name)} {part} SET LOCATION {_text(folder)}")
        else:
            spark.sql(f"ALTER TABLE {_quoted(name)} ADD {part} LOCATION {_text(folder)}")


def catalog_years(spark: SparkSession, *names: str, year_col: str = "year") -> list[int]:
    """The years that any of the tables has, from the catalog alone: no folder is listed, no file is opened."""
    years = set()
    for name in names:
        if spark.catalog.tableExists(name):
            for r in spark.sql(f"SHOW PARTITIONS {_quoted(name)}").collect():
                parts = dict(p.split("=", 1) for p in r["partition"].split("/"))
                years.add(int(parts[year_col]))
    return sorted(years)


def create_tables_per_year(spark: SparkSession, prefix: str, path: str, years: Iterable[int] | None = None) -> dict[int, str]:
    """One external table ``prefix_YYYY`` for each ``year=YYYY`` folder under ``path``; returns their names."""
    wanted = None if years is None else {int(y) for y in years}
    out = {}
    for year, folder in sorted(partition_folders(spark, path).items()):
        if wanted is None or int(year) in wanted:
            name = f"{prefix}_{int(year)}"
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
            spark.catalog.createTable(name, path=folder, source="parquet")
            out[int(year)] = name
    return out


def register_models(spark: SparkSession, built: Mapping[str, str], prefix: str = "") -> dict[str, DataFrame]:
    """External tables over written models, ``{model: path}``; a model partitioned by year is recovered with its years."""
    out = {}
    for model, path in built.items():
        name = f"{prefix}{model}"
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
        spark.catalog.createTable(name, path=path, source="parquet")
        if partition_folders(spark, path):
            spark.catalog.recoverPartitions(name)
        out[model] = spark.table(name)
    return out
