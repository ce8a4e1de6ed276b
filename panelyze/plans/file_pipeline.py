"""The file pipeline: yearly landed CSV -> typed per-year data -> combined panel.

``process_indicators`` and ``process_emissions`` turn the yearly files of
the two sources into typed frames keyed by ``(country, year)``; each can be
written with ``write_years`` so a reload replaces only its years.
``combine_sources`` outer-merges them into the combined panel the models
read (``models.stg_combined``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from panelyze.operators import clean as CL
from panelyze.operators.aggregate import sum_by_key_zero_fill
from panelyze.operators.combine import merge_with_fallbacks
from panelyze.operators.filters import only_years
from panelyze.sinks.versions import publish_years, read_published
from panelyze.sinks.writers import write_years
from panelyze.sources.files import YEAR_IN_NAME, footer_rows, path_exists, read_yearly_csv

# Gas columns summed per (country, year), and the columns of
# the combined panel when neither source has data.
GAS_COLUMNS = ("co2", "ch4", "n2o", "co2e_100yr", "co2e_20yr")
EMPTY_COMBINED = (
    "country",
    "year",
    "sp_pop_totl",
    "ny_gdp_pcap_cd",
    "en_atm_co2e_pc",
    "total_emissions",
    "co2",
    "ch4",
    "n2o",
    "total",
    "co2e_20yr",
    "energy_percent",
)
KEYS = ("country", "year")


def process_indicators(
    spark: SparkSession,
    paths: Sequence[str],
    pattern: str = YEAR_IN_NAME,
    name_col: str = "_metadata.file_name",
) -> DataFrame | None:
    """Indicator files: clean names, every column but the key to a number,
    ``total_emissions`` when population and per-head emissions both exist,
    integer year (from the file name when absent)."""
    df = read_yearly_csv(spark, paths, pattern=pattern, name_col=name_col)
    if df is None:
        return None
    df = CL.cast_numeric_except(df, keep=["country", "_file_year"])
    df = CL.derive_product(df, "sp_pop_totl", "en_atm_co2e_pc", "total_emissions")
    return CL.ensure_year(df).drop("_file_year")


def process_emissions(
    spark: SparkSession,
    paths: Sequence[str],
    pattern: str = YEAR_IN_NAME,
    name_col: str = "_metadata.file_name",
) -> DataFrame | None:
    """Emission files: clean names, numbers, integer year, then the gas
    columns summed per ``(country, year)``.  As in a dataframe library, rows
    with a NULL key are dropped and an all-NULL group sums to 0."""
    df = read_yearly_csv(spark, paths, pattern=pattern, name_col=name_col)
    if df is None:
        return None
    df = CL.cast_numeric_except(df, keep=["country", "year", "_file_year"])
    df = CL.ensure_year(df)
    gases = [g for g in GAS_COLUMNS if g in df.columns]
    return sum_by_key_zero_fill(df, list(KEYS), gases)


def combine_sources(
    indicators: DataFrame | None, emissions: DataFrame | None, years: Sequence[int] | None = None
) -> DataFrame:
    """Full outer merge on ``(country, year)``; shared names get ``_wb`` /
    ``_ct``; one missing or empty side gives the other; none gives an empty
    frame with the combined columns.  With ``years`` only these are merged:
    the filter stands below the merge, on either side, where a table
    partitioned by year opens no other year."""
    sides = [df if df is None else only_years(df, years) for df in (indicators, emissions)]
    return merge_with_fallbacks(*sides, KEYS, EMPTY_COMBINED)


def combine_tables(
    spark: SparkSession, indicator_path: str, emission_path: str, years: Sequence[int] | None = None
) -> DataFrame:
    """``combine_sources`` of two written tables; which of them is absent or empty is read from file footers."""
    sides = []
    for path in (indicator_path, emission_path):
        df = _read_if_written(spark, path)
        has = df is not None and footer_rows(spark, path, years) > 0
        sides.append((df if df is None else only_years(df, years), has))
    (left, has_left), (right, has_right) = sides
    return merge_with_fallbacks(left, right, KEYS, EMPTY_COMBINED, has_rows=(has_left, has_right))


def run(
    spark: SparkSession,
    indicator_paths: Sequence[str],
    emission_paths: Sequence[str],
    out_root: str,
    pattern: str = YEAR_IN_NAME,
    name_col: str = "_metadata.file_name",
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Process both sources, replace their years under ``out_root``, and
    publish and return the combined panel (``sinks.versions``).

    With ``years`` (see ``sources.files.parse_year_list``) only those years
    are processed, merged and replaced; the others stay as they are, and
    readers of the published panel see the reload whole or not at all.
    """
    wb = process_indicators(spark, indicator_paths, pattern, name_col)
    ct = process_emissions(spark, emission_paths, pattern, name_col)
    for name, df in (("indicators", wb), ("emissions", ct)):
        if df is not None:
            write_years(only_years(df, years), f"{out_root}/{name}", "year", ["country"])
    combined = combine_tables(spark, f"{out_root}/indicators", f"{out_root}/emissions", years)
    publish_years(combined, f"{out_root}/combined", "year", ["country"], years)
    written = read_published(spark, f"{out_root}/combined")
    return combined if written is None else written


def _read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table; None where nothing is written yet, which the file system knows."""
    if not path_exists(spark, path):
        return None
    # Years are written one reload at a time, and a column may first come with a later one.
    return spark.read.option("mergeSchema", True).parquet(path)
