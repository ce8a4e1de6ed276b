"""Build the models as tables: the whole staging -> model run in one call.

Each model is written as Parquet under ``out_root/<name>``, partitioned by
year and sorted within each task by its clustering keys (Parquet min/max
statistics then skip row groups for filters on those keys), or written
plainly for the small check tables.  The layout per model follows the
models' declared partitioning and clustering.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from panelyze.operators.quality import check_report, watched
from panelyze.plans import models as M
from panelyze.sinks.writers import write_parquet, write_partitioned_clustered

# Model -> (partition column or None, clustering keys).
LAYOUT: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "dim_emissions": ("year", ("country",)),
    "dim_socio": ("year", ("country", "income_category")),
    "dim_wellbeing": ("year", ("country",)),
    "fct_region": ("year", ("region",)),
    "by_development": ("year", ("income_category",)),
    "time_series": ("year", ("country",)),
    "gdp_correlation": ("year", ("country",)),
    "country_profile": ("year", ()),
    "top_emitters": (None, ()),
    "fct_subregion": (None, ()),
    "region_countries": (None, ()),
    "source_check": (None, ()),
    "join_check": (None, ()),
}

# Models whose writes run side by side: the end of one leaves cores to the next.
AT_ONCE = 4


def model_frames(
    combined: DataFrame,
    countries: DataFrame,
    panel: DataFrame,
    params: M.ModelParams = M.ModelParams(),
    profile_entities=None,
    region: str | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """Lazy builders of every model from the staged frames."""
    out: dict[str, Callable[[], DataFrame]] = {
        "dim_emissions": lambda: M.dim_emissions(panel),
        "dim_socio": lambda: M.dim_socio(panel),
        "dim_wellbeing": lambda: M.dim_wellbeing(panel),
        "fct_region": lambda: M.fct_region(panel, params),
        "by_development": lambda: M.by_development(panel, params),
        "time_series": lambda: M.time_series(panel, params),
        "gdp_correlation": lambda: M.gdp_correlation(panel, params),
        "country_profile": lambda: M.country_profile(panel, profile_entities, params),
        "top_emitters": lambda: M.top_emitters(panel, params),
        "fct_subregion": lambda: M.fct_subregion(panel, params),
        "source_check": lambda: M.source_check(combined),
        "join_check": lambda: M.join_check(combined, countries),
    }
    if region is not None:
        out["region_countries"] = lambda: M.region_countries(panel, region, params)
    return out


def build_models(
    spark: SparkSession,
    frames: dict[str, Callable[[], DataFrame]],
    out_root: str,
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Write the requested models (default all) and return them read back."""
    built: dict[str, DataFrame] = {}
    for name, make in frames.items():
        if only and name not in only:
            continue
        path = f"{out_root.rstrip('/')}/{name}"
        part, cluster = LAYOUT[name]
        df = make()
        if part:
            write_partitioned_clustered(df, path, part, list(cluster))
        else:
            write_parquet(df, path)
        built[name] = spark.read.parquet(path).select(*df.columns)
    return built


def build_and_check(
    spark: SparkSession,
    frames: dict[str, Callable[[], DataFrame]],
    out_root: str,
    not_null: Mapping[str, Sequence[str]],
    unique: Mapping[str, Sequence[Sequence[str]]],
    read_later: Collection[str] = (),
) -> DataFrame:
    """Build models and count their declared checks in the pass that builds them.

    Models without a layout are views: their one pass goes to no sink, but
    those in ``read_later`` are written as plain tables before the next frame
    is made, so that later frames read ``out_root/<name>`` instead of
    computing it again.  The other models do not read each other and are
    written ``AT_ONCE`` at a time.
    Returns ``(model, check_name, failures)``.
    """

    def write(name: str, df: DataFrame, watch: Callable[[DataFrame], DataFrame]) -> None:
        part, cluster = LAYOUT.get(name, (None, ()))
        path = f"{out_root.rstrip('/')}/{name}"
        if part:
            write_partitioned_clustered(df, path, part, list(cluster), watch)
        elif name in LAYOUT or name in read_later:
            write_parquet(watch(df), path)
        else:
            watch(df).write.format("noop").mode("overwrite").save()

    seen, writes = {}, []
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for name, make in frames.items():
            df, watch, seen[name] = watched(make(), not_null.get(name, ()), unique.get(name, ()))
            writes.append(pool.submit(inheritable_thread_target(write), name, df, watch))
            if name in read_later:
                writes[-1].result()
        for done in writes:
            done.result()
    return check_report(spark, seen)
