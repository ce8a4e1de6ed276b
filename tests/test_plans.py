"""Plan-shape checks: the properties the models rely on at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from panelyze.operators import windows as WN
from panelyze.plans import models as M
from tests.test_models import COMBINED_SCHEMA, panel_row


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(plan: str) -> str:
    return plan.split("\n\n", 1)[0]


@pytest.fixture(scope="module")
def panel(spark):
    data = [panel_row(c, y, 10.0 + i, 1000.0 + y, 50.0 + i * y % 7) for i, c in enumerate("ABCDEFG") for y in
            range(2015, 2021)]
    combined = spark.createDataFrame(data, COMBINED_SCHEMA)
    seed = spark.createDataFrame(
        [(f"Name {c}", c, c, str(i), "R1" if i % 2 else "R2", "S1") for i, c in enumerate("ABCDEFG")],
        "name string, `alpha-2` string, `alpha-3` string, `country-code` string, region string, `sub-region` string",
    )
    # A materialised-like input: the panel as a plain relation, so the plan
    # below starts at the models (as when they read the written table).
    p = M.sovereign_panel(M.stg_combined(combined), M.stg_countries(seed))
    return spark.createDataFrame(p.collect(), p.schema)


def test_time_series_one_shuffle_on_entity(panel):
    t = tree(plan_of(M.time_series(panel)))
    exchanges = re.findall(r"Exchange \(\d+\)", t)
    assert len(exchanges) == 1
    full = plan_of(M.time_series(panel))
    assert re.search(r"hashpartitioning\(country#\d+, \d+\)", full)
    assert t.count("Window (") == 1  # lag and baseline share one window pass


def test_no_window_partitioned_by_year_only(panel):
    for model in (M.gdp_correlation, M.time_series, M.country_profile):
        full = plan_of(model(panel))
        specs = re.findall(r"windowspecdefinition\(([^,]+),", full)
        assert specs and all(s.startswith("country") for s in specs), (model.__name__, specs)


def test_top_k_is_partial_before_shuffle(panel):
    top = WN.top_k_per_group(panel, ["year"], [F.col(M.TOTAL).desc(), F.col("country")], 3, "_r")
    t = tree(plan_of(top))
    lines = t.splitlines()
    ex = next(i for i, ln in enumerate(lines) if "Exchange (" in ln)
    assert any("WindowGroupLimit" in ln for ln in lines[ex + 1:])  # below the exchange: map side
    assert any("WindowGroupLimit" in ln for ln in lines[:ex])


def test_aggregations_are_partial(panel):
    full = plan_of(M.fct_region(panel))
    assert "partial_sum" in full and "partial_count" in full


def test_group_stats_join_not_a_window(panel):
    full = plan_of(M.gdp_correlation(panel))
    assert "avg_regional" not in re.sub(r"\s+", "", "".join(re.findall(r"Window \(\d+\).*", full)))
    assert re.search(r"HashAggregate.*\n.*Keys \[2\]: \[year#\d+, region#\d+\]", full) or "Keys [2]: [year" in full


def test_top_emitters_counts_over_ranges(spark, panel):
    from panelyze.session import materialize

    rows = materialize(panel, "plan-panel", ["year"])
    plan = plan_of(M.top_emitters(rows))
    assert tree(plan).count("Scan parquet") <= 3
    assert "lambda" not in plan and "collect_list" not in plan and "row_number()" not in plan


def test_top_row_numbers_uses_no_window_over_a_group(spark, panel, monkeypatch):
    from panelyze.operators import ordinals

    made = []
    monkeypatch.setattr(ordinals, "materialize", lambda df, name: made.append(df) or df)
    ordinals.top_row_numbers(panel, ["year"], "country", {"r": M.TOTAL}, ["r"], 2)
    ranged, numbered = (plan_of(df) for df in made)
    assert "rangepartitioning(year" in ranged and "Window" not in ranged
    # The one window counts ranges, after an aggregation.
    specs = re.findall(r"windowspecdefinition\(([^)]*)\)", numbered)
    assert specs and all("_range" in s for s in specs)
