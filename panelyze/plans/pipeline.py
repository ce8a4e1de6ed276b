"""Wiring: driver tables -> staged panel -> the frame every model reads."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from panelyze.plans import models as M
from panelyze.plans import testpanel
from panelyze.session import input_version, materialize, session_id

_T = testpanel.PanelThresholds()
TEST_PARAMS = M.ModelParams(income=_T.income, intensity=_T.intensity)

# Tables the panel is derived from (their version keys the materialised copy).
_SOURCES = ("orders", "lineitem", "customer", "nation", "region")
# Lazy frames are reused across queries of one session (building them reads
# table footers and analyses the plan); the materialised panel likewise.
_LAZY: dict[tuple, "PanelFrames"] = {}
_MATERIALISED: dict[tuple, DataFrame] = {}


@dataclass
class PanelFrames:
    combined: DataFrame
    seed: DataFrame
    staged: DataFrame
    countries: DataFrame
    panel: DataFrame


def panel_frames(
    spark: SparkSession,
    sf_dir: str,
    params: M.ModelParams = TEST_PARAMS,
    materialised: bool = False,
    staged: DataFrame | None = None,
) -> PanelFrames:
    """Lazy frames of the panel pipeline.

    With ``materialised=True`` the sovereign panel (all dimension columns)
    is written once per session and input version as a table under
    ``spark.checkpoint.dir``, partitioned by year and sorted by country
    (the dimension tables' partitioning and clustering), and the models
    read that table.  ``staged`` is the staged frame of the same tables, if
    the caller has it written: a panel that is yet to be written is then
    built from it, not from the raw tables.
    """
    version = input_version(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in _SOURCES])
    # An input without modification times is never taken from the cache.
    key = (session_id(spark), sf_dir, params, version if version is not None else object())
    frames = _LAZY.get(key)
    if frames is None:
        combined = testpanel.combined_panel(spark, sf_dir)
        seed = testpanel.countries_seed(spark, sf_dir)
        staged = M.stg_combined(combined)
        countries = M.stg_countries(seed)
        panel = M.sovereign_panel(staged, countries, params)
        frames = _LAZY[key] = PanelFrames(combined, seed, staged, countries, panel)
    if not materialised:
        return frames
    if key not in _MATERIALISED:
        panel = frames.panel if staged is None else M.sovereign_panel(staged, frames.countries, params)
        _MATERIALISED[key] = materialize(panel, "sovereign_panel", ["year"], ["year", "country"])
    return replace(frames, panel=_MATERIALISED[key])
